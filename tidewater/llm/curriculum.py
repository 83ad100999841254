"""Mixing sources to target weights along a time-varying curriculum
(operator 10).

Every source has an overall weight and a schedule: its relative weight over
training time, linear between knots. The overall weights give each source a
target number of words (capped at a multiple of what it has, the excess
reshared by weight). Its documents follow each other in an order given by a
hash, pass after pass, until the target is reached; so the k-th word taken has
a known share u = k / target of the source's demand. The integral of the
schedule is the demand met by time t; inverting it at u gives the document's
training position, and a range sort by position is the training order.

All of it is DataFrame expressions. Running sums come in two levels (sums per
source and hash bucket, then within the bucket), so a source with a third of
all rows is never in one task.

Null texts and empty texts have size 0 and are never taken. A null source is a
source of its own, the last in order. Repeated rows each count; rows that share
an id, or have none, are dealt to buckets by their texts like all others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import WORD_PATTERN, stage, whole_text
from tidewater.operators.ranking import global_row_number

WEIGHTS = (3, 1, 2)
SHARE, CAP = 1.5, 2.0
#: Relative weight over training time (0 to 1), by rank like the weights:
#: one source fades, one grows, one is strongest in the middle.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)),
             ((0.0, 0.5), (1.0, 1.5)),
             ((0.0, 0.6), (0.5, 1.4), (1.0, 0.6)))
#: Hex digits of the hash that name a bucket of the running sums.
BUCKET_DIGITS = 3


def invert_demand(schedule: Sequence[tuple[float, float]], share: Column) -> Column:
    """The time at which a schedule's integral reaches ``share`` (0 to 1) of
    its whole. In a segment the integral is a quadratic, solved in the form
    that stays exact for a zero slope."""
    steps = list(zip(schedule[:-1], schedule[1:], strict=True))
    whole = sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in steps)
    out, before = None, 0.0
    for (t0, w0), (t1, w1) in steps:
        area = (t1 - t0) * (w0 + w1) / 2
        need = share * whole - before
        slope = (w1 - w0) / (t1 - t0)
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * need, F.lit(0.0)))
        at = F.lit(t0) + F.when(root + w0 > 0, 2 * need / (root + w0)).otherwise(F.lit(0.0))
        at = F.least(F.greatest(at, F.lit(t0)), F.lit(t1))
        out = at if out is None else F.when(need > 0, at).otherwise(out)
        before += area
    return out


def order_key(doc_id: Column, text_hash: Column) -> Column:
    """The hash that orders a source's documents, of id and text together: an id
    that many rows share is in no one bucket."""
    return F.md5(F.concat_ws("-", text_hash.cast("string"), doc_id.cast("string")).cast("binary"))


def source_targets(sized: DataFrame, weights: Sequence[float], share: float,
                   cap: float) -> DataFrame:
    """(source, source_size, rank, weight, target). Sources that would get more
    than ``cap`` times their size stop there; what they leave is shared by the
    others in proportion to weight, until none is above. Only sums over the
    sources reach the driver."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = global_row_number(totals, [F.col("source").asc_nulls_last()], "rank")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = stage(ranked.withColumn("rank", (F.col("rank") - 1) % len(weights))
                   .withColumn("weight", F.get(cycle, F.col("rank").cast("int"))), "sources")
    most = F.col("source_size") * F.lit(float(cap))
    level, capped = 0.0, -1
    while True:
        full = most <= F.lit(level) * F.col("weight")
        at = ranked.agg(F.sum("source_size").alias("all"),
                        F.sum(F.when(full, F.lit(1)).otherwise(0)).alias("n"),
                        F.sum(F.when(full, F.col("source_size")).otherwise(0)).alias("full"),
                        F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open")).first()
        if at["n"] == capped or not at["open"]:
            break
        capped = at["n"]
        level = (share * at["all"] - cap * at["full"]) / at["open"]
    return ranked.withColumn("target", F.least(most, F.lit(level) * F.col("weight")))


def mix_plan(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
             cap: float = CAP, schedules=SCHEDULES) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, text_hash, size, source_size,
    target, taken (words, all passes together) and the training position of
    each pass that takes words from the document (``positions``, an array)."""
    text = whole_text()
    sized = stage(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source",
        F.xxhash64(text).alias("text_hash"),
        F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long").alias("size"),
        order_key(F.col("doc_id"), F.xxhash64(text)).alias("key")), "sizes")
    sized = sized.withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    targets = source_targets(sized, weights, share, cap)
    sums = sized.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = sums.select(F.col("source").alias("s"), F.col("bucket").alias("b"),
                         F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("start"))
    starts = starts.join(targets,
                         F.col("s").eqNullSafe(targets["source"])).drop("source")
    inside = Window.partitionBy("source", "bucket").orderBy(
        "key", "doc_id", "size", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    rows = sized.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    quota = F.floor("target").cast("long")
    offset = F.col("start") + F.col("inside")
    zero = F.lit(0).cast("long")
    passes = []
    for k in range(-(-int(cap * 1000) // 1000)):
        done = offset + F.lit(k) * F.col("source_size")
        take = F.greatest(F.least(quota - done, F.col("size")), zero)
        passes.append((take, (done + take / 2) / quota))
    taken = sum((p[0] for p in passes[1:]), passes[0][0])
    positions = F.array(*[
        F.when(take > 0, _by_rank(schedules, point)) for take, point in passes])
    return rows.select("doc_id", "source", "text_hash", "size", "source_size", "target",
                       taken.alias("taken"),
                       F.filter(positions, lambda p: p.isNotNull()).alias("positions"))


def _by_rank(schedules, share: Column) -> Column:
    out = F.when(F.col("rank") % len(schedules) == 0, invert_demand(schedules[0], share))
    for k, s in enumerate(schedules[1:], 1):
        out = out.when(F.col("rank") % len(schedules) == k, invert_demand(s, share))
    return out


def curriculum_order(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the mix takes, once for each pass, range-sorted
    by training position; the columns are those of ``docs``. Equal rows are
    paired with their plans one by one."""
    key = ["doc_id", "text_hash", "source"]
    plan = mix_plan(docs, **options).where("taken > 0").select(*key, "positions")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                       F.col("doc_id").cast("long").alias("doc_id"), "source",
                       F.xxhash64(whole_text()).alias("text_hash"))
    nth = F.row_number().over(Window.partitionBy(*key).orderBy("text_hash"))
    plan = plan.withColumn("nth", nth).select(*[F.col(c).alias(f"p_{c}") for c in [*key, "nth"]],
                                              "positions")
    rows = rows.withColumn("nth", nth)
    same = [rows[c].eqNullSafe(plan[f"p_{c}"]) for c in [*key, "nth"]]
    joined = rows.join(plan, same).select("row", F.explode("positions").alias("position"))
    return (joined.repartitionByRange("position", "row.doc_id")
            .sortWithinPartitions("position", "row.doc_id").select("row.*"))
