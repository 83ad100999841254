"""Benchmark decontamination by latent semantic retrieval (operator 7).

Documents are cut into overlapping passages of ``PASSAGE`` words. Passages are
TF-IDF vectors over the benchmark's words; words the benchmark doesn't have are
left out. One pass over all documents counts in how many of them each word
occurs, and in how many passages each two words occur together: the exact Gram
matrix of all passages, as rows that Spark adds up. A randomised SVD (subspace
iteration; each step is a distributed pass over these rows, only a vocabulary x
rank matrix reaches the driver) of the benchmark's passages (weighted, so that
they span the space) and the passages of all documents (together as much as
those of ``FIT_WEIGHT`` average ones) gives the latent space. Every passage of every document that has a word of the
benchmark is then compared with all benchmark passages by their cosine in that
space; the words around it don't hide a passage, however rare they are.

Candidates are confirmed on words: a longest common subsequence of the item and
the text around the passage of at least ``LCS`` of the item, or of ``LOOSE``
of it together with the item's answer (its last sentence). So insertions,
deletions and changed words in between don't hide a passage.

The benchmark is taken in blocks of ``BLOCK_ITEMS`` items, so what a worker
holds has a fixed bound. Null and empty texts are clean; an empty benchmark
leaves all clean; items without words are ignored. Every row, repeated or with
a null id, is judged by itself. An item id that repeats counts once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import slices, stage, text_bytes

PASSAGE, STRIDE = 32, 16
RANK, OVERSAMPLING, POWER_STEPS = 256, 16, 1
#: Average documents that all documents together weigh as much as in the fit.
FIT_WEIGHT = 1_000
#: The benchmark's own passages count this many times in the fit.
ITEM_WEIGHT = 20.0
#: Least cosine in the latent space.
COSINE = 0.5
LCS, LOOSE, ANSWER = 0.75, 0.6, 0.9
BLOCK_ITEMS = 20_000
#: Passages whose pairs of words are taken together, and pairs that a task counts at a time.
_GRID_ROWS, _PAIRS = 16_384, 1 << 24
#: Cells of the Gram matrix that are multiplied together in the SVD's passes.
_CELLS = 1 << 21
_MARKS = b".,;:!?\"'()[]|*$%&#"
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_NONE, _PAD = -1, -2


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_LOWER, _MARKS).split()


def lcs_length(a: list[bytes], b: list[bytes]) -> int:
    """Longest common subsequence, bit-parallel over ``a``."""
    where: dict[bytes, int] = {}
    for i, w in enumerate(a):
        where[w] = where.get(w, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        hit = row & where.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def word_ids(words: list[bytes], place: dict[bytes, int]) -> np.ndarray:
    """The places of the words, _NONE for unknown ones."""
    return np.fromiter(map(place.get, words, repeat(_NONE)), np.int32, len(words))


def all_passages(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The overlapping passages of documents (word ids), padded with _PAD, and how
    many each has; repeats of a word within a passage are blanked out, so it
    counts once."""
    length = np.array([len(ids) for ids in docs], np.int64)
    n = np.where(length > 0, np.maximum(1, -(-(length - (PASSAGE - STRIDE)) // STRIDE)), 0)
    room = np.where(n > 0, (n + 1) * STRIDE, 0)
    start = np.cumsum(room) - room
    if not n.sum():
        return np.empty((0, PASSAGE), np.int32), n
    padded = np.full(room.sum(), _PAD, np.int32)
    for ids, at in zip(docs, start.tolist(), strict=True):
        padded[at:at + len(ids)] = ids
    first = np.repeat(start - STRIDE * (np.cumsum(n) - n), n) + STRIDE * np.arange(n.sum())
    grid = np.sort(np.lib.stride_tricks.sliding_window_view(padded, PASSAGE)[first], axis=1)
    grid[:, 1:][(grid[:, 1:] == grid[:, :-1]) & (grid[:, 1:] >= 0)] = _PAD
    return grid, n


def passages(ids: np.ndarray) -> np.ndarray:
    """The passages of one document."""
    return all_passages([ids])[0]


class Items:
    """A block of benchmark items with their words, vocabulary and answers."""

    def __init__(self, rows: list[tuple[int, bytes]]):
        self.ids, self.words, self.answers = [], [], []
        for item, text in rows:
            if words := words_of(text):
                self.ids.append(item)
                self.words.append(words)
                sentences = [s for s in text.replace(b"\n", b".").split(b".") if s.strip()]
                self.answers.append(words_of(sentences[-1]) if sentences else [])
        self.vocabulary = sorted({w for ws in self.words for w in ws})
        self.place = {w: i for i, w in enumerate(self.vocabulary)}

    def grid(self) -> tuple[np.ndarray, np.ndarray]:
        """All passages of the items, and the item that each is from."""
        grid, n = all_passages([word_ids(ws, self.place) for ws in self.words])
        return grid, np.repeat(np.arange(len(n)), n)


def _pairs(grid: np.ndarray, width: int, kind: type) -> Iterator[np.ndarray]:
    """Each two words (a <= b, a word with itself too) of each passage as a * width + b."""
    known = grid >= 0
    n = known.sum(axis=1)
    for k in np.unique(n[n > 0]).tolist():
        some = n == k
        words = grid[some][known[some]].reshape(-1, k).astype(kind)
        i, j = np.triu_indices(k)
        yield (words[:, i] * width + words[:, j]).ravel()


def _counted(place: dict[bytes, int]):
    """(a, b, n): the passages that hold both words; with b the vocabulary's size, the
    documents that hold a, or with a its size too, all documents."""
    size = len(place)
    width = size + 1
    kind = np.int32 if width * width < 1 << 31 else np.int64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        grids: list[np.ndarray] = []

        def pair() -> None:
            if grids:
                grid = np.concatenate(grids)
                grids.clear()
                for at in range(0, len(grid), _GRID_ROWS):
                    keys.extend(_pairs(grid[at:at + _GRID_ROWS], width, kind))

        def add_up() -> Iterator[pa.RecordBatch]:
            found, n = np.unique(np.concatenate(keys), return_counts=True)
            keys.clear()
            for at in range(0, len(found), 1 << 16):
                a, b = np.divmod(found[at:at + (1 << 16)], width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int32()), pa.array(b, pa.int32()),
                     pa.array(n[at:at + (1 << 16)], pa.int64())], names=["a", "b", "n"])

        for whole in batches:
            for batch in slices(whole):
                docs = [word_ids(words_of(t), place) for t in batch.column(0).to_pylist()]
                ids = np.concatenate(docs).astype(np.int64)
                of = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
                held = np.unique(of[ids >= 0] * width + ids[ids >= 0]) % width
                keys += [(held * width + size).astype(kind), np.full(len(docs), size * width + size, kind)]
                grids.append(all_passages(docs)[0])
                if sum(map(len, grids)) >= _GRID_ROWS:
                    pair()
                    if sum(map(len, keys)) >= _PAIRS:
                        yield from add_up()
        pair()
        if keys:
            yield from add_up()
    return run


def word_counts(text: DataFrame, place: dict[bytes, int]) -> tuple[int, np.ndarray, DataFrame]:
    """Over all rows of ``text`` (bytes): their number, how many hold each word, and
    (a, cells) for each word: the words (b) in a passage with it, and in how many (n)."""
    size = len(place)
    counts = stage(text.mapInArrow(_counted(place), "a int, b int, n long")
                   .groupBy("a", "b").agg(F.sum("n").alias("n")), "word-counts")
    docs, held = 0, np.zeros(size)
    for r in counts.where(F.col("b") == size).collect():     # at most one row a word
        if r["a"] == size:
            docs = r["n"]
        else:
            held[r["a"]] = r["n"]
    sides = F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b"))).otherwise(
        F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    rows = (counts.where(F.col("b") < size).select(F.explode(sides).alias("k"), "n")
            .groupBy("k.a").agg(F.collect_list(F.struct("k.b", "n")).alias("cells")))
    return docs, held, stage(rows, "word-pairs")


def _project(grid: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sum of the table's rows over the known words of each passage."""
    out = np.zeros((len(grid), table.shape[1]), table.dtype)
    known = grid >= 0
    n = known.sum(axis=1)
    for k in np.unique(n[n > 0]).tolist():
        of = np.flatnonzero(n == k)
        words = grid[of][known[of]].reshape(-1, k)
        for at in range(0, len(of), 256):
            out[of[at:at + 256]] = table[words[at:at + 256]].sum(axis=1)
    return out


def _gram_times(grid: np.ndarray, idf: np.ndarray, q: np.ndarray) -> np.ndarray:
    """A'(A q) for the TF-IDF matrix A of the passages."""
    weighted = np.vstack((q * idf[:, None], np.zeros((1, q.shape[1]))))
    total = np.zeros_like(q)
    for at in range(0, len(grid), 2048):
        part = grid[at:at + 2048]
        y = _project(part, weighted)
        r, c = np.nonzero(part >= 0)
        np.add.at(total, part[r, c], y[r])
    return total * idf[:, None]


def _times(q: np.ndarray):
    """The product of each row of the Gram matrix and q."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, max(1, _CELLS // len(q))):
                cells = batch.column(1)
                b, n = cells.flatten().flatten()
                dense = np.zeros((batch.num_rows, len(q)))
                dense[np.repeat(np.arange(len(dense)), cells.value_lengths().to_numpy()),
                      b.to_numpy()] = n.to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([r.tobytes() for r in dense @ q], pa.binary())],
                    names=["a", "row"])
    return run


def latent_space(rows: DataFrame, share: float, items: Items, idf: np.ndarray,
                 rank: int = RANK) -> np.ndarray:
    """Right singular vectors (vocabulary x rank) by a randomised SVD of the items'
    passages and those counted in ``rows`` (see ``word_counts``), which weigh ``share``."""
    size = len(items.vocabulary)
    width = min(rank + OVERSAMPLING, size)
    own, _ = items.grid()

    def gram(q: np.ndarray) -> np.ndarray:
        total = ITEM_WEIGHT * _gram_times(own, idf, q)
        for r in rows.mapInArrow(_times(q * idf[:, None]), "a int, row binary").collect():
            total[r["a"]] += share * idf[r["a"]] * np.frombuffer(r["row"])
        return total

    q = np.random.default_rng(7).standard_normal((size, width))
    for _ in range(1 + POWER_STEPS):
        q, _ = np.linalg.qr(gram(q))
    values, vectors = np.linalg.eigh(q.T @ gram(q))
    order = np.argsort(values)[::-1][:min(rank, width)]
    return (q @ vectors[:, order]).astype(np.float32)


class Searcher:
    """Everything that a task needs to judge documents against a block."""

    def __init__(self, items: Items, idf: np.ndarray, space: np.ndarray, cosine: float):
        self.items, self.cosine = items, cosine
        self.table = np.vstack((space * idf[:, None].astype(np.float32),
                                np.zeros((1, space.shape[1]), np.float32)))
        grid, self.owner = items.grid()
        vectors = _project(grid, self.table)
        self.vectors = (vectors / (np.linalg.norm(vectors, axis=1, keepdims=True) + 1e-9)).T.copy()

    def candidates(self, grid: np.ndarray) -> Iterator[tuple[int, int]]:
        """(passage, item) pairs whose cosine reaches the threshold."""
        may = np.flatnonzero((grid >= 0).any(axis=1))
        for at in range(0, len(may), 1024):
            some = may[at:at + 1024]
            vectors = _project(grid[some], self.table)
            length = np.linalg.norm(vectors, axis=1, keepdims=True)
            r, c = np.nonzero((vectors @ self.vectors >= self.cosine * length) & (length > 0))
            yield from sorted(set(zip(some[r].tolist(), self.owner[c].tolist(), strict=True)))

    def confirm(self, words: list[bytes], passage: int, item: int) -> float:
        """Share of the item in the text around the passage, 0 if not enough."""
        target, answer = self.items.words[item], self.items.answers[item]
        lo = max(0, passage * STRIDE - len(target))
        around = words[lo:passage * STRIDE + PASSAGE + len(target)]
        # no common subsequence is longer than the item's words that occur at all
        if sum(map(set(around).__contains__, target)) < min(LCS, LOOSE) * len(target):
            return 0.0
        share = lcs_length(target, around) / len(target)
        if share >= LCS:
            return share
        if share >= LOOSE and answer and lcs_length(answer, around) >= ANSWER * len(answer):
            return share
        return 0.0

    def judge(self, texts: list[bytes]) -> list[dict[int, float]]:
        split = [words_of(t) for t in texts]
        grid, n = all_passages([word_ids(ws, self.items.place) for ws in split])
        first = np.concatenate(([0], np.cumsum(n)))
        found: list[dict[int, float]] = [{} for _ in texts]
        for passage, item in self.candidates(grid):
            doc = int(np.searchsorted(first, passage, "right")) - 1
            share = self.confirm(split[doc], passage - int(first[doc]), item)
            if share > found[doc].get(item, 0.0):
                found[doc][item] = share
        return found


def _judge(searcher: Searcher):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                found = searcher.judge(batch.column(2).to_pylist())
                ids = [sorted({searcher.items.ids[i] for i in f}) for f in found]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(ids, pa.list_(pa.int64())),
                     pa.array([max(f.values(), default=0.0) for f in found], pa.float64())],
                    names=["row", "doc_id", "item_ids", "overlap"])
    return run


def _searchers(docs: DataFrame, benchmark: DataFrame, cosine: float) -> Iterator[Searcher]:
    """One searcher per block of items; all of ``docs`` give frequencies and space."""
    text = docs.select(text_bytes().alias("text"))
    rows = (benchmark.where("item_id IS NOT NULL")
            .select(F.col("item_id").cast("long").alias("item_id"), text_bytes().alias("text"))
            .orderBy("item_id", "text").toLocalIterator())
    block: list[tuple[int, bytes]] = []
    ended = False
    while not ended:
        row = next(rows, None)
        ended = row is None
        if row is not None:
            block.append((row["item_id"], bytes(row["text"])))
        if not block or not (ended or len(block) >= BLOCK_ITEMS):
            continue
        items, block = Items(block), []
        if not items.ids:
            continue
        n, held, pairs = word_counts(text, items.place)
        idf = np.log((n + 1) / (held + 1)) + 0.1
        space = latent_space(pairs, min(1.0, FIT_WEIGHT / max(n, 1)), items, idf)
        yield Searcher(items, idf, space, cosine)


def contaminated_documents(docs: DataFrame, benchmark: DataFrame,
                           cosine: float = COSINE) -> DataFrame:
    """(doc_id, contaminated, item_ids, overlap), one row per row of ``docs``."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"),
                       F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    schema = "row long, doc_id long, item_ids array<long>, overlap double"
    parts = [rows.mapInArrow(_judge(s), schema) for s in _searchers(docs, benchmark, cosine)]
    if not parts:
        out = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                          F.array().cast("array<long>").alias("item_ids"), F.lit(0.0).alias("overlap"))
    elif len(parts) == 1:
        out = parts[0]
    else:      # an item id is in one block only, or repeats in the next
        out = (reduce(DataFrame.union, parts).groupBy("row", "doc_id")
               .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids"))))
                    .alias("item_ids"), F.max("overlap").alias("overlap")))
    return out.select("doc_id", (F.size("item_ids") > 0).alias("contaminated"), "item_ids", "overlap")


def _clean(searcher: Searcher):
    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        out: list[bool] = []
        for at in range(0, len(texts), 256):
            out += [not found for found in searcher.judge(list(texts[at:at + 256]))]
        return pd.Series(out, dtype=bool)
    return clean


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns."""
    for searcher in list(_searchers(docs, benchmark, cosine)):
        docs = docs.where(_clean(searcher)(text_bytes()))
    return docs
