"""Exact duplicates by a tree-merge of sorted digest runs (operator 6).

Only DataFrame functions. Each input split is a run of (digest, best row,
count), sorted by digest by its sort-based partial aggregation. Runs then meet
in rounds: in every round ``2 ** rounds_at_once`` neighbouring runs (that many
binomial rounds at a time) are merged per digest, keeping the verified best
row and the sum of the counts, until one run is left. Going back down the same
tree hands the winner to every document. A digest has at most one row per run,
so a group with a third of all rows never meets in one task.

Texts are equal when their SHA-256 and, as the verification carried through
every level, their 64-bit xxHash are equal after white space is deleted. A
null text counts as empty; empty texts are a group like any other. Null ids
come last in a tie; rows that tie in length and id are told apart by their
place, so exactly one row of a group stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import SPACE_CHARS, stage, whole_text

_KEYS = ["digest", "check"]


def without_space(text: Column) -> Column:
    for c in SPACE_CHARS:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def exact_duplicates(docs: DataFrame, rounds_at_once: int = 3) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of
    ``docs`` (doc_id, text; other columns are ignored). The longest original
    text stays, then the smallest doc_id."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.length(whole_text()).alias("chars"),
                       without_space(whole_text()).alias("plain"))
    rows = stage(rows.select(
        "doc_id", "chars", F.unhex(F.sha2(F.col("plain"), 256)).alias("digest"),
        F.xxhash64("plain").alias("check"),
        F.spark_partition_id().alias("run"),
        F.monotonically_increasing_id().alias("place")), "digests")
    fan = 2 ** rounds_at_once
    runs = (rows.agg(F.max("run")).first()[0] or 0) + 1

    level = rows.select("run", *_KEYS, F.lit(1).cast("long").alias("size"),
                        F.struct((-F.col("chars")).alias("shorter"),
                                 F.col("doc_id").isNull().alias("no_id"),
                                 "doc_id", "place").alias("best"))
    levels = []
    while True:
        runs = -(-runs // fan)
        level = stage(level.groupBy(F.floor(F.col("run") / fan).cast("int").alias("run"), *_KEYS)
                      .agg(F.sum("size").alias("size"), F.min("best").alias("best")), "runs")
        levels.append(level)
        if runs == 1:
            break

    winner = levels.pop().select("run", *_KEYS, "size", "best")
    while levels:
        below = levels.pop().select(F.col("run").alias("at"), *_KEYS,
                                    F.floor(F.col("run") / fan).cast("int").alias("run"))
        winner = (below.join(winner, ["run", *_KEYS])
                  .select(F.col("at").alias("run"), *_KEYS, "size", "best"))
    out = (rows.withColumn("run", F.floor(F.col("run") / fan).cast("int"))
           .join(winner, ["run", *_KEYS]))
    return out.select("doc_id", F.col("best.doc_id").alias("keep_id"),
                      F.col("size").alias("group_size"),
                      (F.col("place") == F.col("best.place")).alias("kept"),
                      F.lower(F.hex("digest")).alias("text_sha256"))
