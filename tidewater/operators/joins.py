"""Join helpers.

No lookup is broadcast by force: AQE measures the shuffled lookup at run time
and broadcasts it below ``spark.sql.autoBroadcastJoinThreshold``; beyond that a
hot lookup key is split by AQE's skew join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.collation import collated_columns, spelling
from tidewater.session import staged, staging_path

SKETCH_GROUPS = 64
MAX_COUNTERS = 1 << 19


def left_join_spread_null_keys(left: DataFrame, right: DataFrame, key: str,
                               buckets: int | None = None, salt_from: str | None = None) -> DataFrame:
    """``left LEFT JOIN right USING (key)`` where many left rows may have a
    null key. A null key never matches, but a hash shuffle still sends every
    null-keyed row to the same reducer; if a third of the rows are null that
    one task does a third of the work. Both sides are joined on (key, salt):
    right rows and non-null left rows carry salt 0, null-keyed left rows a
    deterministic salt from a hash of one column (``salt_from``, by default
    the first; a row id spreads best), so they spread over ``buckets``
    reducers and still match nothing. One evaluation of each side, no extra
    shuffle. Hashing a single column keeps column pruning and join
    elimination working for the columns a query does not use."""
    n = buckets or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.when(F.col(key).isNull(),
                  F.pmod(F.xxhash64(F.col(salt_from or left.columns[0])), F.lit(n))) \
            .otherwise(F.lit(0)).cast("long")
    # 0 for every right row that can match; written as an expression rather
    # than a literal, which the optimizer would fold into a join filter and
    # drop from the shuffle keys
    right_salt = F.when(F.col(key).isNotNull(), F.lit(0)).cast("long")
    out = left.withColumn("_tw_salt", salt).join(
        right.withColumn("_tw_salt", right_salt), [key, "_tw_salt"], "left")
    return out.drop("_tw_salt")


def _summaries(df: DataFrame, keys: list[str], counters: int) -> DataFrame:
    """Row count and a sketch of each key, for groups of tasks."""
    return df.select(*keys).groupBy(
        F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_tw_g")).agg(
        F.count(F.lit(1)).alias("_tw_c"),
        *[F.call_function("approx_top_k_accumulate", F.col(k), F.lit(counters)).alias(f"_tw_s{j}")
          for j, k in enumerate(keys)])


def _frequent(df: DataFrame, keys: list[str], n: int, min_hot_rows: int) -> dict[str, DataFrame]:
    """For each key (item): its values, null among them, above four average
    partitions' worth of rows. See ``hot_keys``."""
    spark = df.sparkSession
    counters = min(max(1024, 1 << (4 * n - 1).bit_length()), MAX_COUNTERS)
    limit = max(4.0 / n, 7.0 / counters)         # of all rows; well above the sketch's error
    top = min(n // 2 + 2, counters)
    names = [f"_tw_s{j}" for j in range(len(keys))]
    collated = collated_columns(df, keys)        # by a text that equal values share, nearly always
    partial = _summaries(df.select(*[F.lower(F.rtrim(spelling(k))).alias(k) if k in collated else F.col(k)
                                     for k in keys]), keys, counters)
    # by a constant, so that no rows give no summary instead of a null one
    merged = partial.groupBy(F.lit(0).alias("_tw_all")).agg(F.sum("_tw_c").alias("_tw_c"), *[F.call_function(
        "approx_top_k_estimate", F.call_function("approx_top_k_combine", F.col(s), F.lit(counters)),
        F.lit(top)).alias(s) for s in names])
    small = staged(merged, staging_path(spark, "hot-keys"))
    return {k: small.select("_tw_c", F.explode(s).alias("e")).where(
                (F.col("e.count") >= F.lit(min_hot_rows))
                & (F.col("e.count") > F.col("_tw_c") * F.lit(limit))).select("e.item")
            for k, s in zip(keys, names)}


def spread_evenly(df: DataFrame, key: str, partitions: int, min_hot_rows: int = 100_000) -> bool:
    """Whether no value of ``key``, nor null, holds more than four average partitions'
    worth of rows, so that rows dealt by its hash make no oversized task. One pass
    over the column; one row is looked at."""
    return _frequent(df, [key], partitions, min_hot_rows)[key].isEmpty()


def even_buckets(df: DataFrame, key: str, number: int, min_hot_rows: int = 100_000) -> bool:
    """Whether rows dealt by the hash of ``key`` into ``number`` buckets make no
    oversized one: of ``min_hot_rows`` and five average buckets' worth (its own share and
    four of one hot value). One pass that counts the buckets themselves."""
    sizes = df.groupBy(F.pmod(F.hash(key), F.lit(number))).agg(F.count(F.lit(1)).alias("n"))
    largest, rows = sizes.agg(F.max("n"), F.sum("n")).first()
    return not rows or largest < min_hot_rows or largest * number <= 5 * rows


def hot_keys(df: DataFrame, keys, partitions: int | None = None,
             min_hot_rows: int = 100_000) -> dict[str, DataFrame]:
    """For each column in ``keys``, the values holding more than four average
    partitions' worth of rows of ``df`` (and at least ``min_hot_rows``), as a
    frame (key, _tw_hot=true).

    One pass with a mergeable frequent-items sketch a key (``approx_top_k_*``):
    a task's summary has a fixed number of counters however many values it
    meets, ``SKETCH_GROUPS`` reducers merge the tasks' summaries and one task merges
    theirs, so what is shuffled grows with the number of tasks, not of values.
    With at least 4 counters a partition a count is off by less than one
    average partition (3.5 / counters of all rows), so no value above the limit
    is missed; one within that error below it may be listed too, which costs
    its join a few salted rows and nothing else. A value that is listed holds more
    than three average partitions' worth, so there are at most ``partitions / 3``,
    which bounds the broadcast; they are written once, and consumers share them."""
    keys = list(keys)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = {}
    for k, found in _frequent(df, keys, n, min_hot_rows).items():
        found = found.where(F.col("item").isNotNull()).select(F.col("item").cast(df.schema[k].dataType).alias(k))
        if collated_columns(df, [k]):       # equal under the collation: one value
            found = found.distinct()
        out[k] = found.select(k, F.lit(True).alias("_tw_hot"))
    return out


def left_join_salted(left: DataFrame, right: DataFrame, key: str, hot: DataFrame,
                     salt_from: str, salts: int | None = None) -> DataFrame:
    """``left LEFT JOIN right USING (key)`` with the keys listed in ``hot``
    (see ``hot_keys``) spread over ``salts`` reducers: their left rows get a
    salt from a hash of ``salt_from``, their right rows are repeated once per
    salt; null keys are salted too (they match nothing)."""
    salts = salts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.pmod(F.xxhash64(F.col(salt_from)), F.lit(salts))
    l = left.join(F.broadcast(hot), key, "left")
    l = l.withColumn("_tw_salt", F.when(F.col(key).isNull() | F.col("_tw_hot"), spread)
                     .otherwise(F.lit(0)).cast("long")).drop("_tw_hot")
    r = right.join(F.broadcast(hot), key, "left").withColumn(
        "_tw_salt", F.explode(F.when(F.col("_tw_hot"), F.sequence(F.lit(0).cast("long"),
                                                                  F.lit(salts - 1).cast("long")))
                              .otherwise(F.array(F.lit(0).cast("long"))))).drop("_tw_hot")
    return l.join(r, [key, "_tw_salt"], "left").drop("_tw_salt")


def left_join_split_hot_keys(left: DataFrame, right: DataFrame, key: str, salt_from: str,
                             salts: int | None = None, min_hot_rows: int = 100_000,
                             partitions: int | None = None) -> DataFrame:
    """``left LEFT JOIN right USING (key)`` that stays balanced when a few keys
    hold a large share of ``left`` (one order with a third of all items):
    ``hot_keys`` on ``left`` (eager, one pass) then ``left_join_salted``.
    Evaluates ``left`` twice: use it on a materialised or cheap input."""
    hot = hot_keys(left, [key], partitions, min_hot_rows)[key]
    return left_join_salted(left, right, key, hot, salt_from, salts or partitions)


def join_back(rows: DataFrame, values: DataFrame, keys, size: str, spread: Column,
              salts: int = 64) -> DataFrame:
    """``rows`` with the columns of ``values``, which has one row for each key or
    none (null equals null), and in ``size`` how many rows have the key. A key of
    more than ``salts`` rows meets them in ``salts`` pieces, dealt by ``spread``; so a
    key with a third of all rows is in no one task, and ``values`` grows to at most
    the number of rows."""
    names = [c for c in values.columns if c not in keys and c != size]
    packed = values.select(*[F.col(k).alias(f"_tw_k{i}") for i, k in enumerate(keys)],
                           F.struct(*names).alias("_tw_v"), (F.col(size) > salts).alias("_tw_wide"))
    many = (packed.where("_tw_wide").drop("_tw_wide")
            .withColumn("_tw_s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
    # 0, written as an expression so that it stays among the shuffle keys
    few = (packed.where("NOT _tw_wide").drop("_tw_wide")
           .withColumn("_tw_s", F.when(F.col("_tw_v").isNotNull(), 0)))

    def matched(left: DataFrame, right: DataFrame) -> DataFrame:
        on = left["_tw_salt"] == right["_tw_s"]
        for i, k in enumerate(keys):
            on = on & left[k].eqNullSafe(right[f"_tw_k{i}"])
        return left.join(right, on, "left")

    out = rows.withColumn("_tw_salt", F.pmod(spread, F.lit(salts)).cast("int"))
    out = matched(out, many).select(*rows.columns, "_tw_salt", F.col("_tw_v").alias("_tw_m"))
    out = out.withColumn("_tw_salt", F.when(F.col("_tw_m").isNull(), 0).otherwise(F.col("_tw_salt") + 1))
    return matched(out, few).select(
        *[out[c] for c in rows.columns],
        *[F.coalesce(F.col("_tw_m")[c], F.col("_tw_v")[c]).alias(c) for c in names])
