"""Document likelihood over all segmentations (operator 4).

The pieces of an existing subword vocabulary are the units of a unigram model.
A document's tokens are its words (A-Z lowered) and one end; pieces that begin
a word carry the vocabulary's word mark and none crosses a word, so the
marginal probability of a text is the product over its words of the sum over
all segmentations of each word, times that of the end. A word's sum is the
forward recursion over its lattice in log space; characters that the
vocabulary lacks go through its byte pieces.

The vocabulary's own scores (ranks) give the first weights, by Zipf's law. They
are re-estimated on the training documents by expectation-maximisation: every
distinct training word, weighted by its count, adds its expected piece counts
(forward-backward); the counts of all words are gathered in Spark.

The word counts also give the base score. Words above ``FREQUENT`` of all
training tokens (at most 1 / FREQUENT of them) are looked up from a broadcast,
which also removes every hot key; the rest are joined by word.

Null texts count as empty: one end token. Each row is scored by itself, so
repeated rows and repeated ids give one result row each; a null id is a
training document (crc32 of '' is 0). With no training text every word has
count 0 and the first weights stay.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import crc_fold, slices, stage, text_bytes

FOLDS, HELD_OUT = 7, 2
FREQUENT = 5e-7
MARK = "▁"
EM_ROUNDS = 1
#: Pseudo-count of each piece, so that none gets probability 0.
SMOOTH = 0.1
#: Distinct words that a task holds before it hands their counts on.
HELD_WORDS = 250_000
LOG10 = math.log(10)


def load_pieces(path: str) -> tuple[list[str], list[float]]:
    """Pieces of a vocabulary file that can occur inside a word (byte pieces as
    '<0x..>'), and their scores there."""
    from sentencepiece import SentencePieceProcessor
    sp = SentencePieceProcessor(model_file=path)
    pieces, scores = [], []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i) or not (sp.is_unknown(i) or sp.is_control(i) or sp.is_unused(i)
                                 or MARK in piece[1:] or any("A" <= c <= "Z" for c in piece)):
            pieces.append(piece)
            scores.append(sp.get_score(i))
    return pieces, scores


def first_weights(scores: list[float]) -> np.ndarray:
    """Probabilities by Zipf's law over the ranks that the scores give; scores
    of 0 (byte pieces) come last. One more weight, for the end, is appended."""
    rank = np.array([-s for s in scores])
    rank[rank == 0] = rank.max() + 1
    p = 1 / (rank - rank.min() + 10)
    return np.append(p / p.sum() * 0.99, 0.01)


class Lattice:
    """Forward (and backward) recursion over the segmentations of a word."""

    def __init__(self, pieces: list[str], weights: np.ndarray):
        logs = np.log(weights).tolist()
        self.end = logs[len(pieces)]
        self.byte = [0.0] * 256
        self.byte_place = [0] * 256
        #: every beginning of a piece; (log weight, place) where it is a piece
        self.tree: dict[str, tuple[float, int] | None] = {}
        for i, piece in enumerate(pieces):
            if len(piece) == 6 and piece.startswith("<0x"):
                self.byte[int(piece[3:5], 16)], self.byte_place[int(piece[3:5], 16)] = logs[i], i
                continue
            for k in range(1, len(piece)):
                self.tree.setdefault(piece[:k], None)
            self.tree[piece] = (logs[i], i)

    def _bytes(self, char: str) -> float:
        return sum(self.byte[b] for b in char.encode())

    def forward(self, text: str, arcs: list | None = None) -> list[float]:
        """Log of the summed weight of all segmentations of each beginning. The
        pieces used are added to ``arcs`` as (start, end, log weight, place),
        without a place where a character goes through its bytes."""
        find, n = self.tree.get, len(text)
        exp, log1p, none = math.exp, math.log1p, -math.inf
        alpha = [none] * (n + 1)
        alpha[0] = 0.0
        for i in range(n):
            a, alone = alpha[i], True
            for j in range(i + 1, n + 1):
                found = find(text[i:j], False)
                if found is False:
                    break
                if found is not None:
                    x, y = a + found[0], alpha[j]
                    if y == none:
                        alpha[j] = x
                    elif x > y:
                        alpha[j] = x + log1p(exp(y - x))
                    else:
                        alpha[j] = y + log1p(exp(x - y))
                    if j == i + 1:
                        alone = False
                    if arcs is not None:
                        arcs.append((i, j, *found))
            if alone:                                # no piece of this one character
                weight = self._bytes(text[i])
                x, y = a + weight, alpha[i + 1]
                alpha[i + 1] = x if y == none else max(x, y) + log1p(exp(-abs(x - y)))
                if arcs is not None:
                    arcs.append((i, i + 1, weight, None))
        return alpha

    def expect(self, text: str, count: float, total: list[float]) -> None:
        """Add ``count`` times the expected number of each piece to ``total``."""
        arcs: list[tuple] = []
        alpha, n = self.forward(text, arcs), len(text)
        whole, exp, log1p, none = alpha[n], math.exp, math.log1p, -math.inf
        beta = [none] * n + [0.0]
        for i, j, log, place in reversed(arcs):      # by falling start
            x, y = log + beta[j], beta[i]
            if y == none:
                beta[i] = x
            elif x > y:
                beta[i] = x + log1p(exp(y - x))
            else:
                beta[i] = y + log1p(exp(x - y))
            weight = count * exp(alpha[i] + x - whole)
            if place is not None:
                total[place] += weight
            else:
                for b in text[i].encode():
                    total[self.byte_place[b]] += weight

    def word(self, word: bytes) -> float:
        """Log probability of a word, all segmentations together."""
        return self.forward(MARK + word.decode("utf-8", "replace"))[-1]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    train: Counter = Counter()
    other: set[bytes] = set()

    def emit() -> pa.RecordBatch:
        other.difference_update(train)
        out = pa.RecordBatch.from_arrays(
            [pa.array([*train, *other], pa.binary()),
             pa.array([*train.values(), *repeat(0, len(other))], pa.int64())], names=["word", "c"])
        train.clear()
        other.clear()
        return out

    for whole in batches:
        for batch in slices(whole):
            for held, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                  strict=True):
                words = text.lower().split()
                if held:
                    other.update(words)
                else:
                    train.update(words)
                if len(train) + len(other) > HELD_WORDS:
                    yield emit()
    yield emit()


def _expected(pieces: list[str], weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, sums = Lattice(pieces, weights), [0.0] * len(pieces)
        for batch in batches:
            for word, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                               strict=True):
                lattice.expect(MARK + word.decode("utf-8", "replace"), c, sums)
        total = np.array(sums)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])],
                                         names=["place", "expected"])
    return run


def _marginals(pieces: list[str], weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces, weights)
        for batch in batches:
            logs = [lattice.word(w) / LOG10 for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(logs, pa.float64())],
                names=["word", "c", "log10"])
    return run


def _score_frequent(shared, base_of: tuple[float, float], end_log10: float, end_count: int):
    """Per document one row with the sums over its frequent words, and one row
    for each of its other words. The summary's key has a blank in front, which
    no word has."""
    log10 = math.log10

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts, logs = shared.value
        known = {w: (log10(c + 1) - base_of[1], x) for w, c, x in
                 zip(words, counts.tolist(), logs.tolist(), strict=True)}
        end_base = log10(end_count + 1) - base_of[1]
        for whole in batches:
            for batch in slices(whole):
                row: list[int] = []
                key: list[bytes] = []
                n: list[int] = []
                sums: list[tuple] = []
                for rid, doc, held, text in zip(*(c.to_pylist() for c in batch.columns),
                                                strict=True):
                    split = text.lower().split()
                    n_known, base, score = int(end_count > 0), end_base, end_log10
                    for word, times in Counter(split).items():
                        hit = known.get(word)
                        if hit is None:
                            row.append(rid)
                            key.append(word)
                            n.append(times)
                            sums.append((None, None, None, None, None, None))
                        else:
                            n_known += times
                            base += times * hit[0]
                            score += times * hit[1]
                    row.append(rid)
                    key.append(b" %d" % rid)
                    n.append(0)
                    sums.append((doc, held, len(split) + 1, n_known, base, score))
                types = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row, pa.int64()), pa.array(key, pa.binary()), pa.array(n, pa.int64()),
                     *[pa.array([s[k] for s in sums], t) for k, t in enumerate(types)]],
                    names=["row", "word", "n", "doc_id", "held_out", "n_tokens", "n_known",
                           "base", "score"])
    return run


def lattice_scores(docs: DataFrame, vocabulary: str, em_rounds: int = EM_ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one
    row per row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (crc_fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
                       text_bytes().alias("text"))
    words = stage(rows.select("held_out", "text").mapInArrow(_count_words, "word binary, c long")
                  .groupBy("word").agg(F.sum("c").alias("c")), "words")
    ends = rows.where("NOT held_out").select("doc_id").count()
    sums = words.where("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"),
                                    F.count("*").alias("v")).first()
    tokens, distinct = sums["n"] + ends, sums["v"] + (ends > 0)

    pieces, scores = load_pieces(vocabulary)
    weights = first_weights(scores)
    for _ in range(em_rounds if sums["n"] else 0):
        found = (words.where("c > 0").mapInArrow(_expected(pieces, weights),
                                                 "place long, expected double")
                 .groupBy("place").agg(F.sum("expected").alias("expected")).collect())
        counts = np.full(len(pieces) + 1, SMOOTH)
        for r in found:                                 # at most one per piece
            counts[r["place"]] += r["expected"]
        counts[-1] += ends
        # rounded, so that the order of the sums leaves no trace
        weights = np.round(counts / counts.sum(), 15)

    scored = stage(words.mapInArrow(_marginals(pieces, weights),
                                    "word binary, c long, log10 double"), "scored")
    often = F.col("c") >= FREQUENT * max(tokens, 1)
    # at most 1 / FREQUENT words
    head = scored.where(often & (F.col("c") > 0)).toPandas()
    shared = spark.sparkContext.broadcast(
        ([bytes(w) for w in head["word"]], head["c"].to_numpy(np.int64), head["log10"].to_numpy(float)))
    del head
    norm = math.log10(tokens + distinct + 1)
    run = _score_frequent(shared, (0.0, norm), math.log10(weights[-1]), ends)
    parts = (rows.withColumn("row", F.monotonically_increasing_id())
             .select("row", "doc_id", "held_out", "text")
             .mapInArrow(run, "row long, word binary, n long, doc_id long, held_out boolean, "
                              "n_tokens long, n_known long, base double, score double"))
    rare = scored.where(~(often & (F.col("c") > 0)))
    base = F.log10(F.col("c") + 1) - F.lit(norm)
    joined = parts.join(rare, "word", "left")
    return (joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"),
        F.max("n_tokens").alias("n_tokens"),
        F.sum(F.coalesce("n_known", F.when(F.col("c") > 0, F.col("n")).otherwise(0))).alias("n_known"),
        F.sum(F.coalesce(F.col("base"), F.col("n") * base)).alias("base_score"),
        F.sum(F.coalesce(F.col("score"), F.col("n") * F.col("log10"))).alias("score"))
        .select("doc_id", "held_out", "n_tokens", "n_known",
                F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score"))
