"""Exact quantile buckets without ranking the rows.

``NTILE(b)`` needs only the ``b - 1`` keys at which its buckets end. They are
found by refining a histogram of the order keys:

1. count the rows; the standard's bucket sizes give the ranks of the bounds;
2. cut the order into ranges at sampled keys and count the rows of each (one
   aggregate of at most ``PIVOTS + 1`` groups, so next to nothing is shuffled);
3. only a range that holds a bound's rank and more than ``small`` rows is cut
   again, at keys sampled from itself, by the next count;
4. what is left, at most ``small`` keys a bound, is counted by key and summed up
   in order, one task a range; the keys at the bounds' ranks come out.

A row's bucket is then a comparison of its own keys with the bounds: the rows
themselves are neither shuffled, sorted nor given numbers. The driver holds the
sampled keys (about ``PIVOTS``) and the bounds, never more.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.session import staging_path

PIVOTS = 256
MAX_BUCKETS = 256
_KEY = "_tw_key{}"
_NAN = float("nan")


def _after(ascending: Sequence[bool], bound) -> Column:
    """Whether a row's keys come after ``bound``, null being the least value."""
    out = F.lit(False)
    for i in reversed(range(len(ascending))):
        key, value = F.col(_KEY.format(i)), bound[i]
        if value is None:
            beyond = key.isNotNull() if ascending[i] else F.lit(False)
            same = key.isNull()
        else:
            beyond = key > F.lit(value) if ascending[i] else (key < F.lit(value)) | key.isNull()
            same = key.eqNullSafe(F.lit(value))
        out = F.coalesce(beyond, F.lit(False)) | (same & out)
    return out


def _place(ascending: Sequence[bool], bounds: Sequence) -> Column:
    """How many of the ordered ``bounds`` a row comes after, by halving."""
    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(_after(ascending, bounds[middle]), search(middle + 1, high)) \
            .otherwise(search(low, middle))
    return search(0, len(bounds))


def _key(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        raise ValueError(f"an order key of type {kind.simpleString()} has no literals to compare with")
    # an instant is compared as a number, a literal of it depends on the time zone
    return F.unix_micros(column) if isinstance(kind, T.TimestampType) else column


def _values(row) -> tuple:
    """A key that compares equal to itself, not-a-number included."""
    return tuple(_NAN if v != v else bytes(v) if isinstance(v, bytearray) else v for v in row)


def _sorting(ascending: Sequence[bool]) -> list[Column]:
    return [F.col(_KEY.format(i)).asc_nulls_first() if up else F.col(_KEY.format(i)).desc_nulls_last()
            for i, up in enumerate(ascending)]


def bucket_bounds(keys: DataFrame, ascending: Sequence[bool], ranks: Sequence[int], total: int,
                  small: int = 100_000) -> list[tuple]:
    """The keys at the given ranks (from 1, ascending) of ``keys``' rows. Every
    round reads ``keys`` once, so it should be a cheap scan."""
    names = [_KEY.format(i) for i in range(len(ascending))]
    pivots: list[tuple] = []
    counts = [total]
    stuck: dict[tuple, int] = {}       # ranges without a new key so far, by their last key
    done: set[tuple] = set()           # ranges that proved to hold one key only

    def end(i: int):
        return pivots[i] if i < len(pivots) else None

    rounds = 0
    while True:
        ends = list(accumulate(counts))
        held = sorted({next(i for i, e in enumerate(ends) if r <= e) for r in ranks})
        wide = [i for i in held if counts[i] > small and end(i) not in done]
        if not wide:
            break
        rounds += 1
        want = max(8, PIVOTS // len(wide))
        rates = {i: min(1.0, want * 8.0 ** stuck.get(end(i), 0) / counts[i]) for i in wide}
        place = _place(ascending, pivots)
        # by a hash of the keys, so rows that repeat them are picked as one key
        draw = F.pmod(F.xxhash64(F.lit(rounds), *names), F.lit(1 << 40)) / F.lit(float(1 << 40))
        rate = F.coalesce(F.element_at(F.create_map(
            *[F.lit(x) for pair in rates.items() for x in pair]), F.col("_tw_place")), F.lit(0.0))
        drawn = (keys.withColumn("_tw_place", place).where(draw < rate)
                 .select("_tw_place", *names).distinct()
                 .orderBy("_tw_place", *_sorting(ascending)).collect())
        fresh: dict[int, list[tuple]] = {i: [] for i in wide}
        for row in drawn:
            key = _values(row[1:])
            if key != end(row[0]):
                fresh[row[0]].append(key)
        for i in wide:
            if not fresh[i]:
                if rates[i] == 1.0:
                    done.add(end(i))
                else:
                    stuck[end(i)] = stuck.get(end(i), 0) + 1
        # the ends of the ranges that hold a bound, and what was drawn within them
        cuts: list[tuple] = []
        for i in held:
            around = pivots[max(i - 1, 0):i] + fresh.get(i, []) + pivots[i:i + 1]
            cuts += [key for key in around if key not in cuts[-1:]]
        pivots = cuts
        found = dict(keys.groupBy(_place(ascending, pivots).alias("p")).count().collect())
        counts = [found.get(i, 0) for i in range(len(pivots) + 1)]

    before = [0, *accumulate(counts)]
    inside = keys.withColumn("_tw_place", _place(ascending, pivots)).where(F.col("_tw_place").isin(held))
    running = Window.partitionBy("_tw_place").orderBy(*_sorting(ascending))
    upto = (F.sum("_tw_n").over(running)
            + F.element_at(F.create_map(*[F.lit(x) for i in held for x in (i, before[i])]),
                           F.col("_tw_place")))
    summed = (inside.groupBy("_tw_place", *names).agg(F.count(F.lit(1)).alias("_tw_n"))
              .withColumn("_tw_upto", upto))
    hits = F.filter(F.array(*[F.lit(r).cast("long") for r in ranks]),
                    lambda r: (r <= F.col("_tw_upto")) & (r > F.col("_tw_upto") - F.col("_tw_n")))
    rows = summed.select(F.explode(hits).alias("rank"), *names).orderBy("rank").collect()
    return [_values(r[1:]) for r in rows]


def quantile_buckets(df: DataFrame, order: Sequence[tuple[str, bool]], buckets: int, out_col: str,
                     stage_input: bool = True, small: int = 100_000) -> DataFrame:
    """``df`` plus ``out_col`` = ``NTILE(buckets) OVER (ORDER BY order)`` (E8). ``order``:
    (column, ascending) pairs; a null is the least value, as in the source. Rows that are
    equal in all of them share the earliest bucket that any of them would get, so
    a total order gives exactly NTILE.

    Eager: the bounds are found by a few aggregates (see the module). ``df`` is
    written once before unless it is a cheap scan (``stage_input=False``)."""
    if not 1 <= buckets <= MAX_BUCKETS:
        raise ValueError(f"1 to {MAX_BUCKETS} buckets, not {buckets}; rank the rows for more (global_ntile)")
    spark = df.sparkSession
    if stage_input:
        path = staging_path(spark, f"quantiles-{out_col}")
        df.write.mode("overwrite").parquet(path)
        df = spark.read.schema(df.schema).parquet(path)
    ascending = [up for _, up in order]
    as_keys = [_key(df[c], df.schema[c].dataType).alias(_KEY.format(i)) for i, (c, _) in enumerate(order)]
    keys = df.select(*as_keys)
    total = df.count()
    base, extra = divmod(total, buckets)
    # where each bucket but the last ends; buckets beyond the rows are empty
    ranks = sorted({i * base + min(i, extra) for i in range(1, buckets)} - {0, total})
    bounds = bucket_bounds(keys, ascending, ranks, total, small) if ranks else []
    return (df.select("*", *as_keys)
            .withColumn(out_col, (_place(ascending, bounds) + F.lit(1)).cast("int"))
            .drop(*[_KEY.format(i) for i in range(len(order))]))
