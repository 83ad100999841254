"""Toxicity by non-negative positive-unlabelled learning (operator 3).

Only confirmed toxic examples carry a label into training; everything else is
unlabelled. A document is the set of its words and word beginnings. The
features are those that occur in confirmed examples significantly more often
than in the corpus: their counts cover every training document. A linear
classifier is then fitted in numpy on a bounded sample (``MAX_POSITIVE``
confirmed and ``MAX_UNLABELLED`` unlabelled documents, chosen by a hash of the
id) with the class-prior-corrected risk

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))

and its non-negative correction; the prior is the share of toxic rows among
the labelled training rows. Its sigmoid is the score.

Null and empty texts have no features and get the score of the intercept. A
null id belongs to the training side. Rows are scored one by one, so repeated
rows get equal scores. Without confirmed examples every score is 0.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import crc_fold, picked_rows, slices, stage, text_bytes

FOLDS, HELD_OUT = 4, 2
MAX_POSITIVE, MAX_UNLABELLED = 10_000, 25_000
#: A feature is in at least this share of the confirmed documents, and in MIN_DOCS.
MIN_SHARE, MIN_DOCS = 0.002, 4
MIN_Z = 5.0
CUT = 0.3
#: Lengths of the word beginnings.
BEGINNINGS = (4, 5, 6)
_MARKS = b".,;:!?\"'()[]{}|%$*&#<>"
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Words whose features a worker remembers.
MEMORY = 120_000


def words_of(text: bytes) -> set[bytes]:
    """Distinct words, A-Z lowered, marks around and inside them dropped."""
    return set(text.translate(_LOWER, _MARKS).split())


def features_of(word: bytes) -> list[bytes]:
    """The word, and its beginnings (by code points) if it is longer."""
    text = word.decode("utf-8", "ignore")
    return [word] + [b"^" + text[:k].encode() for k in BEGINNINGS if len(text) > k]


class FeatureIndex:
    """word -> places of its chosen features, remembered per worker."""

    def __init__(self, features: list[bytes]):
        self.place = {f: i for i, f in enumerate(features)}
        self.known: dict[bytes, tuple[int, ...]] = {}

    def __call__(self, text: bytes) -> list[int]:
        known, out = self.known, set()
        if len(known) > MEMORY:
            known.clear()
        for word in words_of(text):
            places = known.get(word)
            if places is None:
                places = known[word] = tuple(self.place[f] for f in features_of(word)
                                             if f in self.place)
            if places:
                out.update(places)
        return list(out)


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()

    def emit() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()),
                                          pa.array(list(seen.values()), pa.int64())],
                                         names=["feature", "n"])
        seen.clear()
        return out

    for whole in batches:
        for batch in slices(whole):
            for text in batch.column(0).to_pylist():
                seen.update({f for w in words_of(text) for f in features_of(w)})
                if len(seen) > MEMORY:
                    yield emit()
    yield emit()


def _count_chosen(features: list[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, total, docs = FeatureIndex(features), np.zeros(len(features) + 1, np.int64), 0
        for whole in batches:
            for batch in slices(whole):
                texts = batch.column(0).to_pylist()
                docs += len(texts)
                for text in texts:
                    total[index(text)] += 1      # places of a document are distinct
        total[-1] = docs
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(total[found])],
                                         names=["place", "n"])
    return run


def _vectors(features: list[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = FeatureIndex(features)
        for whole in batches:
            for batch in slices(whole):
                places = [index(t) for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(places, pa.list_(pa.int32()))],
                    names=["toxic", "places"])
    return run


def _csr(rows: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list array and the row that each is from."""
    return (pc.list_flatten(rows).to_numpy(zero_copy_only=False).astype(np.int64),
            pc.list_parent_indices(rows).to_numpy(zero_copy_only=False).astype(np.int64))


def fit_nnpu(positive: pa.Array, unlabelled: pa.Array, width: int, prior: float,
             steps: int = 400, rate: float = 0.05, l2: float = 1e-5) -> tuple[np.ndarray, float]:
    """Weights that minimise the non-negative PU risk with the logistic loss, by
    full-batch Adam (deterministic), and the intercept that agrees with the
    prior. The documents are list arrays of feature places."""
    fp, rp = _csr(positive)
    fu, ru = _csr(unlabelled)
    n_p, n_u = len(positive), len(unlabelled)
    w = np.zeros(width + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)

    def scores(flat, rows, n):
        return np.bincount(rows, w[flat], n) + w[-1]

    def back(flat, rows, g):
        return np.append(np.bincount(flat, g[rows], width), g.sum())

    for t in range(1, steps + 1):
        zp = 1 / (1 + np.exp(-scores(fp, rp, n_p)))
        zu = 1 / (1 + np.exp(-scores(fu, ru, n_u)))
        negative = (-np.log1p(-np.minimum(zu, 1 - 1e-12))).mean() - prior * (
            -np.log1p(-np.minimum(zp, 1 - 1e-12))).mean()
        grad_minus = back(fu, ru, zu / n_u) - prior * back(fp, rp, zp / n_p)
        if negative < 0:          # the estimate is below zero: step back out of it
            grad = -grad_minus
        else:
            grad = prior * back(fp, rp, (zp - 1) / n_p) + grad_minus
        grad[:-1] += l2 * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w[:-1], _level(np.bincount(ru, w[fu], n_u), prior)


def _level(z: np.ndarray, prior: float) -> float:
    """The intercept at which the unlabelled documents' mean score is the prior."""
    lo, hi = -40.0 - z.max(), 40.0 - z.min()
    for _ in range(80):
        mid = (lo + hi) / 2
        if (1 / (1 + np.exp(-(z + mid)))).mean() < prior:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2


class ToxicityModel:
    def __init__(self, features: list[bytes], weights: np.ndarray, intercept: float):
        self.features, self.weights, self.intercept = features, weights, intercept

    def scorer(self):
        features, weights, intercept = self.features, self.weights, self.intercept

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = FeatureIndex(features)
            for whole in batches:
                for batch in slices(whole):
                    z = np.array([weights[index(t)].sum() for t in batch.column(2).to_pylist()])
                    score = 1 / (1 + np.exp(-(z + intercept)))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0), batch.column(1), pa.array(score),
                         pa.array((score >= CUT).astype(np.int32))],
                        names=["doc_id", "held_out", "score", "predicted"])
        return run


def train_toxicity(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """``docs`` (doc_id, text), ``labels`` (doc_id, toxic). Rows of the held-out
    fold are left out of every step."""
    train = docs.select("doc_id", text_bytes().alias("text")).where(
        crc_fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()
                          & (crc_fold(F.col("doc_id"), FOLDS) != HELD_OUT))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    share = known.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
    nothing = ToxicityModel([], np.zeros(0), -50.0)
    if not share["toxic"] or not share["n"]:
        return nothing
    prior = min(max(share["toxic"] / share["n"], 1e-4), 0.9)

    def one_of(n: int, most: int):
        """A hash of the id picks about ``most`` of ``n`` ids, or all."""
        return F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * min(1, most / n))

    # bounded: at most about MAX_POSITIVE ids, and one text of each
    positive = known.where("toxic = 1").where(one_of(share["toxic"], MAX_POSITIVE)).select("doc_id")
    n_train = train.select("doc_id").count()
    if not n_train:
        return nothing
    sample = stage(
        train.join(F.broadcast(positive), "doc_id", "left_semi")
        .groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
        .select(F.lit(1).alias("toxic"), "text")
        .union(picked_rows(train, MAX_UNLABELLED, n_train).select(F.lit(0), "text"))
        .select(F.col("toxic").cast("int").alias("toxic"), "text"), "sample")
    confirmed = sample.where("toxic = 1").select("text")
    n_pos = confirmed.count()
    if not n_pos:
        return nothing
    # at most (features of a document) / MIN_SHARE rows
    least = max(MIN_DOCS, MIN_SHARE * n_pos)
    frequent = (confirmed.repartition(8).mapInArrow(_count_features, "feature binary, n long")
                .groupBy("feature").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
                .toArrow().sort_by("feature"))
    names = frequent.column("feature").to_pylist()
    a = frequent.column("n").to_numpy().astype(float)
    found = (train.select("text").mapInArrow(_count_chosen(names), "place long, n long")
             .groupBy("place").agg(F.sum("n").alias("n")).toArrow())
    counts = np.zeros(len(names) + 1)
    counts[found.column("place").to_numpy()] = found.column("n").to_numpy()
    b = counts[:-1]
    p, q = a / n_pos, b / n_train
    both = (a + b) / (n_pos + n_train)
    z = (p - q) / np.sqrt(np.maximum(both * (1 - both), 1e-12) * (1 / n_pos + 1 / n_train))
    chosen = [names[i] for i in np.flatnonzero(z >= MIN_Z)]
    rows = (sample.mapInArrow(_vectors(chosen), "toxic int, places array<int>")
            .orderBy("toxic", "places").toArrow().combine_chunks())
    lists = pa.concat_arrays(rows.column("places").chunks)
    toxic = rows.column("toxic").to_numpy() == 1
    weights, intercept = fit_nnpu(lists.filter(pa.array(toxic)), lists.filter(pa.array(~toxic)),
                                  len(chosen), prior)
    used = np.flatnonzero(weights)
    return ToxicityModel([chosen[i] for i in used], weights[used], intercept)


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (crc_fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
                       text_bytes().alias("text"))
    return rows.mapInArrow(model.scorer(),
                           "doc_id long, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier doesn't call toxic, all columns."""
    model = train_toxicity(docs, labels)
    features, weights, intercept = model.features, model.weights, model.intercept

    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        index = _index(features)
        z = np.array([weights[index(t)].sum() for t in texts], float) + intercept
        return pd.Series(1 / (1 + np.exp(-z)) < CUT)

    return docs.where(clean(text_bytes()))


_indexes: dict[int, FeatureIndex] = {}


def _index(features: list[bytes]) -> FeatureIndex:
    key = hash(tuple(features))
    if key not in _indexes:
        _indexes.clear()
        _indexes[key] = FeatureIndex(features)
    return _indexes[key]
