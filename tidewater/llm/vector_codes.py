"""Product codes of vectors with Drake-Hamerly adaptive bounds (operator 13).

Components become integers floor(4096 * x), vectors are cut into equal
consecutive parts, and every part position has a codebook of a few entries that
rounds of assigning and averaging improve. All results are integers, so they
don't depend on how Spark splits the rows.

Between rounds each vector's row keeps, for every part, its ``b`` closest entries
in order: an upper bound of the distance to the first (the assigned) one, lower
bounds for the others, each of which also holds for all that come after it, and
one outer bound for the entries that aren't listed. When entries move, bounds
move by as much. A part is certain when its upper bound is below the next lower
bound; otherwise its distance is computed in integers, then those of the
listed entries that the ordered bounds can't rule out, and of all entries only
where the outer bound fails. Ties go to the lower index. ``b`` adapts from round
to round: it shrinks to the ranks that were looked at and grows where many parts
needed all entries. Bounds are stored as 32-bit floats rounded to the safe side.

A round is two jobs: rows with their bounds are written to the shared folder
(the state of the round before is removed afterwards), and sums per entry, some
thousand numbers however many rows there are, come back to the driver.

Dropped: rows whose vector is null or holds null or non-finite components. The
dimension is that of the smallest kept vec_id; vectors of another one have null
code and error. A dimension that the parts don't divide is filled up with zeros.
Components beyond +-32768 count as that. Repeated rows and null ids (last in
order) are rows like any other; with fewer kept rows than entries the codebooks
are that small; null labels are a label of their own. No rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import join_back
from tidewater.session import staging_path

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Largest component; squared distances of parts of 64 then fit in 64 bits.
LIMIT = 1 << 27
#: First number of listed entries, its least value, and the shares of parts that
#: make it grow (all entries needed) or keep a rank (looked at that far).
FIRST_LISTED, LEAST_LISTED, GROW_SHARE, RANK_SHARE = 4, 2, 0.05, 0.001
NONE = 255          # no entry listed at this rank
_STATE = "vec_id long, label string, ints array<int>, near binary, low binary, looked binary"


def _up(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


def squared_distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows ``x`` (n, w) to ``entries`` (k, w), int64."""
    peak = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * peak * peak * max(1, x.shape[1]) < 1 << 53:      # exact in doubles
        a, c = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (c * c).sum(1) - 2 * (a @ c.T)).astype(np.int64)
    return ((x[:, None, :] - entries) ** 2).sum(2)


def _listed(d2: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``b`` closest entries by (distance, index) and their bounds, the outer
    one last, from all exact distances."""
    order = np.argsort(d2, axis=1, kind="stable")
    dist = np.sqrt(np.take_along_axis(d2, order, 1).astype(np.float64))
    near = np.full((len(d2), b), NONE, np.uint8)
    low = np.full((len(d2), b + 1), np.inf, np.float32)
    k = min(b, d2.shape[1])
    near[:, :k] = order[:, :k]
    low[:, :k] = _down(dist[:, :k])
    low[:, 0] = _up(dist[:, 0])
    if d2.shape[1] > b:
        low[:, b] = _down(dist[:, b])
    return near, low


def _resize(near: np.ndarray, low: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """The lists with room for ``b`` entries; bounds stay in order."""
    have = near.shape[1]
    if b < have:        # ordered: the first bound that goes holds for all others
        return near[:, :b], low[:, :b + 1]
    wider = np.full((len(near), b), NONE, np.uint8)
    wider[:, :have] = near
    bounds = np.repeat(low[:, -1:], b + 1, axis=1)
    bounds[:, :have] = low[:, :-1]
    return wider, bounds


def reassign(x: np.ndarray, entries: np.ndarray, moved: np.ndarray, near: np.ndarray,
             low: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists and bounds of one part position after its entries moved, and how far
    each row was looked at: 0 by bounds alone, r by integer distances to its first
    r entries, NONE to all."""
    near, low = _resize(near, low, b)
    step = np.append(moved, 0.0)[np.where(near == NONE, len(moved), near)]
    bound = low.astype(np.float64)
    bound[:, 0] += step[:, 0]
    bound[:, 1:-1] -= step[:, 1:]
    bound[:, -1] -= moved.max(initial=0.0)
    low = np.empty_like(low)
    low[:, 0] = _up(bound[:, 0])
    # each lower bound holds for everything behind it
    low[:, 1:] = _down(np.minimum.accumulate(bound[:, :0:-1], axis=1)[:, ::-1])
    near, looked = near.copy(), np.zeros(len(x), np.uint8)

    open_ = np.flatnonzero(low[:, 0] >= low[:, 1])
    own = ((x[open_] - entries[near[open_, 0]]) ** 2).sum(1)
    low[open_, 0] = _up(np.sqrt(own.astype(np.float64)))
    looked[open_] = 1
    open_ = open_[low[open_, 0] >= low[open_, 1]]
    deep = open_[low[open_, 0] >= low[open_, -1]]
    if len(deep):
        near[deep], low[deep] = _listed(squared_distances(x[deep], entries), b)
        looked[deep] = NONE
    few = np.setdiff1d(open_, deep, assume_unique=True)
    if len(few):
        at = near[few]
        # ranks whose bound doesn't rule them out; the outer bound does for the rest
        rank = (low[few, 1:] <= low[few, :1]).sum(1)
        inside = (np.arange(b) <= rank[:, None]) & (at != NONE)
        d2 = ((x[few, None, :] - entries[np.where(at == NONE, 0, at)]) ** 2).sum(2)
        d2 = np.where(inside, d2, np.iinfo(np.int64).max)
        # what wasn't looked at keeps its rank, which its bound belongs to
        order = np.lexsort((np.where(inside, at, NONE + np.arange(b)), d2), axis=1)
        near[few] = np.take_along_axis(at, order, 1)
        dist = np.sqrt(np.take_along_axis(d2, order, 1).astype(np.float64))
        beyond = np.take_along_axis(low[few], rank[:, None] + 1, 1)
        known = np.minimum(_down(dist), beyond)
        known[:, 0] = _up(dist[:, 0])
        low[few, :b] = np.where(inside, known, low[few, :b])
        looked[few] = rank + 1
    return near, low, looked


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _assigner(books: np.ndarray, moved: np.ndarray | None, listed: int,
              b: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Assign rows to ``books`` (parts, entries, width). ``moved``: how far each
    entry went since the rows' bounds, with ``listed`` entries, were right."""
    parts, _, width = books.shape

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ints, n = batch.column("ints"), batch.num_rows
            x = _matrix(ints, parts * width).reshape(n, parts, width)
            near, low = np.empty((n, parts, b), np.uint8), np.empty((n, parts, b + 1), np.float32)
            looked = np.full((n, parts), NONE, np.uint8)
            if moved is not None:
                old = np.frombuffer(b"".join(batch.column("near").to_pylist()), np.uint8)
                old_low = np.frombuffer(b"".join(batch.column("low").to_pylist()), np.float32)
                old, old_low = old.reshape(n, parts, listed), old_low.reshape(n, parts, listed + 1)
            for p in range(parts):
                if moved is None:
                    near[:, p], low[:, p] = _listed(squared_distances(x[:, p], books[p]), b)
                else:
                    near[:, p], low[:, p], looked[:, p] = reassign(
                        x[:, p], books[p], moved[p], old[:, p], old_low[:, p], b)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), ints, _binary(near), _binary(low),
                 _binary(looked)], names=["vec_id", "label", "ints", "near", "low", "looked"])
    return assign


def _adder(parts: int, entries: int, width: int, b: int):
    """Sums and counts of what is assigned to each entry, and how often parts were
    looked at to each depth (part -1), of one task."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, width), np.int64)
        counts = np.zeros((parts, entries), np.int64)
        depth = np.zeros(256, np.int64)
        for batch in batches:
            n = batch.num_rows
            x = _matrix(batch.column("ints"), parts * width).reshape(n, parts, width)
            near = np.frombuffer(b"".join(batch.column("near").to_pylist()), np.uint8)
            at = near.reshape(n, parts, b)[:, :, 0]
            for p in range(parts):
                np.add.at(sums[p], at[:, p], x[:, p])
                counts[p] += np.bincount(at[:, p], minlength=entries)
            looked = np.frombuffer(b"".join(batch.column("looked").to_pylist()), np.uint8)
            depth += np.bincount(looked, minlength=256)
        p, e, w = (i.reshape(-1) for i in np.indices(sums.shape))
        seen = np.flatnonzero(depth)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate((p, np.full(len(seen), -1))).astype(np.int32)),
             pa.array(np.concatenate((e, seen)).astype(np.int32)),
             pa.array(np.concatenate((w, np.zeros(len(seen)))).astype(np.int32)),
             pa.array(np.concatenate((sums.reshape(-1), np.zeros(len(seen), np.int64)))),
             pa.array(np.concatenate((np.repeat(counts.reshape(-1), width), depth[seen])))],
            names=["part", "entry", "place", "total", "n"])
    return add


def _coder(books: np.ndarray, b: int):
    parts, _, width = books.shape

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x = _matrix(batch.column("ints"), parts * width).reshape(n, parts, width)
            near = np.frombuffer(b"".join(batch.column("near").to_pylist()), np.uint8)
            at = near.reshape(n, parts, b)[:, :, 0]
            error = ((x - books[np.arange(parts), at]) ** 2).sum((1, 2))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"),
                 pa.array([r.tobytes().hex() for r in np.ascontiguousarray(at)]), pa.array(error)],
                names=["vec_id", "label", "code", "error"])
    return code


def next_listed(b: int, looked: dict[int, int]) -> int:
    """How many entries to list next, from how far parts were looked at."""
    all_ = sum(looked.values())
    if looked.get(NONE, 0) > GROW_SHARE * all_:
        return min(2 * b, ENTRIES // 2)
    deepest = max((r for r, n in looked.items() if r != NONE and n >= RANK_SHARE * all_), default=0)
    return min(b, max(deepest, LEAST_LISTED))


def _remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _kept(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.where(F.col("embedding").isNotNull() & finite)

    def whole(x: Column) -> Column:
        return F.floor(F.greatest(F.least(x.cast("double") * SCALE, F.lit(float(LIMIT))),
                                  F.lit(float(-LIMIT)))).cast("int")
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"),
                       F.col("label").cast("string").alias("label"),
                       F.transform("embedding", whole).alias("ints"))


def encode_vectors(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES,
                   rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray, list[dict]]:
    """Codes of ``vectors`` (vec_id, embedding, label): a frame (vec_id, label, code,
    error), the codebooks (parts, entries, width) and, for every round, ``b`` and
    how many parts were looked at how far (0: certain by their bounds)."""
    spark = vectors.sparkSession
    path = staging_path(spark, "vector-ints")
    _kept(vectors).write.parquet(path)
    rows = spark.read.schema("vec_id long, label string, ints array<int>").parquet(path)
    seeds = [r.ints for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "ints")
             .select("ints").limit(entries).collect()]
    dim = len(seeds[0]) if seeds else 0
    fill = -dim % parts
    width = (dim + fill) // parts
    other = rows.where(F.size("ints") != dim)
    rows = rows.where(F.size("ints") == dim)
    if fill:
        rows = rows.withColumn("ints", F.concat("ints", F.array_repeat(F.lit(0), fill)))
    seeds = [s + [0] * fill for s in seeds if len(s) == dim]
    books = np.array(seeds, np.int64).reshape(len(seeds), parts, width).transpose(1, 0, 2).copy()
    if not books.size:
        empty = rows.select("vec_id", "label", F.lit("00" * parts).alias("code"),
                            F.lit(0).cast("long").alias("error"))
        return empty.union(_uncoded(other)), books, []

    def write(frame: DataFrame, moved, listed: int, b: int) -> tuple[DataFrame, str]:
        to = staging_path(spark, "vector-bounds")
        frame.mapInArrow(_assigner(books, moved, listed, b), _STATE).write.parquet(to)
        return spark.read.schema(_STATE).parquet(to), to

    b, log = min(FIRST_LISTED, books.shape[1]), []
    state, at = write(rows, None, 0, b)
    for _ in range(rounds):
        total = (state.select("ints", "near", "looked")
                 .mapInArrow(_adder(*books.shape, b),
                             "part int, entry int, place int, total long, n long")
                 .groupBy("part", "entry", "place").agg(F.sum("total"), F.sum("n")).collect())
        looked = {e: n for p, e, _, _, n in total if p == -1}
        log.append({"b": b, "looked": looked})
        new = books.copy()
        for p, e, w, s, n in total:
            if p >= 0 and n:
                new[p, e, w] = s // n
        moved = np.sqrt(((new - books) ** 2).sum(2).astype(np.float64)) * (1 + 1e-12)
        books, listed = new, b
        b = b if NONE in looked and len(looked) == 1 else next_listed(b, looked)
        state, new_at = write(state, moved, listed, b)
        _remove(spark, at)
        at = new_at
    coded = state.select("vec_id", "label", "ints", "near").mapInArrow(
        _coder(books, b), "vec_id long, label string, code string, error long")
    return coded.union(_uncoded(other)), books, log


def _uncoded(rows: DataFrame) -> DataFrame:
    return rows.select("vec_id", "label", F.lit(None).cast("string").alias("code"),
                       F.lit(None).cast("long").alias("error"))


def codebook_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def vector_codes(vectors: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256), one row per kept row."""
    coded, books, _ = encode_vectors(vectors)
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"),
                                      F.count("*").alias("rows"))
    out = join_back(coded, sums, ["label"], "rows", F.xxhash64("vec_id", "code", "error"))
    return out.select("vec_id", "code", "error", "label_error",
                      F.lit(codebook_digest(books)).alias("codebooks_sha256"))


def oracle_sql(dim: int = 64) -> str:
    """The query in SQL, round after round, for vectors of ``dim`` components."""
    width = dim // PARTS

    def assigned(name: str, book: str) -> str:
        return f"""
d{name} AS (
  SELECT r, p.part, b.entry, sum((p.v - b.v) * (p.v - b.v)) AS d2
  FROM parts p JOIN {book} b ON p.part = b.part AND p.place = b.place GROUP BY ALL),
a{name} AS MATERIALIZED (
  SELECT r, part, arg_min(entry, (d2, entry)) AS entry, min(d2) AS d2 FROM d{name} GROUP BY ALL)"""
    steps = []
    for k in range(ROUNDS):
        steps.append(assigned(str(k), f"b{k}"))
        steps.append(f"""
s{k} AS (
  SELECT p.part, a.entry, p.place, sum(p.v) AS s, count(*) AS n
  FROM parts p JOIN a{k} a ON p.r = a.r AND p.part = a.part GROUP BY ALL),
b{k + 1} AS MATERIALIZED (
  SELECT part, entry, place,
         coalesce(CAST((s - ((s % n) + n) % n) // n AS BIGINT), b.v) AS v
  FROM b{k} b LEFT JOIN s{k} USING (part, entry, place))""")
    steps.append(assigned("x", f"b{ROUNDS}"))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS r, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor(x::DOUBLE * {SCALE}) AS BIGINT)) AS ints
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cells AS (SELECT r, unnest(range({dim})) AS i, unnest(ints) AS v FROM kept),
parts AS MATERIALIZED (SELECT r, i // {width} AS part, i % {width} AS place, v FROM cells),
b0 AS MATERIALIZED (SELECT part, r AS entry, place, v FROM parts WHERE r < {ENTRIES}),
{",".join(steps)},
coded AS (
  SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code,
         CAST(sum(d2) AS BIGINT) AS error FROM ax GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, place)) FROM b{ROUNDS})
         AS codebooks_sha256
FROM kept JOIN coded USING (r)
"""
