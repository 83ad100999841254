"""Global ordered numbering without a single-partition stage.

``ROW_NUMBER() OVER (ORDER BY k)`` with no PARTITION BY makes Spark gather every
row into one task (``Exchange SinglePartition``). Here instead:

0. (default) write the input once as a table, so that the range bounds are
   sampled from, and the rows numbered from, one materialised result rather
   than two evaluations of an expensive upstream plan (sampling runs the
   input once, the shuffle a second time); it is removed when step 3 is done;
1. range-partition on the order keys and sort inside each partition, so the
   partitions are ordered and each is sorted;
2. tag each row with ``monotonically_increasing_id`` (partition id in the upper
   31 bits, position in the partition in the lower 33);
3. write that frame once as a table under ``spark.checkpoint.dir``. This fixes
   the sampled range bounds and cuts the lineage: a lost executor re-reads the
   table instead of recomputing (possibly differently bounded) partitions;
4. count rows per partition (reads one column of the table), turn the counts
   into running offsets -- one row per partition, so the window over them and
   the broadcast of them are bounded by the partition count, not the data;
5. number = offset of the row's partition + its position + 1.

The order keys must form a total order (add tie-breakers), otherwise the
numbering among ties is arbitrary, as in any database.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.session import drop_staged, staged, staging_path

_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1


def _order_cols(order: Sequence) -> list[Column]:
    return [o if isinstance(o, Column) else F.col(o) for o in order]


def global_row_number(df: DataFrame, order: Sequence, out_col: str,
                      num_partitions: int | None = None, stage_input: bool = True) -> DataFrame:
    """``df`` plus ``out_col`` = 1..N following ``order`` (E6). Eager: stages the
    ranked rows as a parquet table and returns a frame reading it. Pass
    ``stage_input=False`` when ``df`` is already a cheap scan."""
    spark = df.sparkSession
    order = _order_cols(order)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = df
    if stage_input:
        path_in = staging_path(spark, f"rownum-input-{out_col}")
        source = staged(df, path_in)
        if num_partitions is None:
            # at least one range partition per input split (~128 MB each), so
            # partitions stay bounded in size however large the input grows;
            # a plain scan, so counting its splits plans without running a job
            n = max(n, source.rdd.getNumPartitions())
    tagged = (source.repartitionByRange(n, *order)
                .sortWithinPartitions(*order)
                .withColumn("_tw_mid", F.monotonically_increasing_id()))
    ranked = staged(tagged, staging_path(spark, f"rownum-{out_col}"))
    if stage_input:
        drop_staged(spark, path_in)

    part = F.shiftright(F.col("_tw_mid"), _POS_BITS).alias("_tw_pid")
    counts = ranked.groupBy(part).agg(F.count(F.lit(1)).alias("_tw_n"))
    before = Window.orderBy("_tw_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_tw_pid", F.coalesce(F.sum("_tw_n").over(before), F.lit(0))
                            .alias("_tw_off"))
    numbered = ranked.join(F.broadcast(offsets),
                           F.shiftright(ranked["_tw_mid"], _POS_BITS) == offsets["_tw_pid"])
    number = F.col("_tw_off") + (F.col("_tw_mid").bitwiseAND(F.lit(_POS_MASK))) + F.lit(1)
    return numbered.select(number.cast("long").alias(out_col), *[F.col(c) for c in df.columns])


def ntile_from_rank(rank: Column, total: Column, buckets: int) -> Column:
    """``NTILE(buckets)`` from a 1-based rank and the row count: the first
    ``total % buckets`` buckets get one extra row, as the SQL standard says."""
    b = F.lit(buckets)
    base = (total / b).cast("long")
    rem = total - base * b
    big = base + F.lit(1)
    head = F.ceil(rank / big)
    tail = rem + F.ceil((rank - rem * big) / F.nullif(base, F.lit(0)))
    return F.when(rank <= rem * big, head).otherwise(tail).cast("int")


def global_ntile(df: DataFrame, order: Sequence, buckets: int, out_col: str,
                 num_partitions: int | None = None) -> DataFrame:
    """``NTILE(buckets) OVER (ORDER BY order)`` (E8) on top of the distributed row
    number; the row count comes from a scalar subquery, not the driver."""
    ranked = global_row_number(df, order, "_tw_rank", num_partitions)
    total = ranked.select(F.count(F.lit(1))).scalar()
    return ranked.withColumn(out_col, ntile_from_rank(F.col("_tw_rank"), total, buckets)) \
                 .drop("_tw_rank")
