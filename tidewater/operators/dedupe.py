"""Deduplication operators.

``keep_first`` keeps one row per key, the first in a given order. It is written
as a grouped ``min``/``max`` over a struct whose leading fields are the order
columns, not as ``row_number() = 1`` over a window: the aggregate gets a
map-side partial step, so a key that holds a third of all rows is collapsed to
one row per map task before the shuffle, while a window would pull every row of
that key into one task. The trailing struct fields (all remaining columns) make
the choice deterministic when the order columns tie.

Null ordering matches a database that sorts nulls lowest: descending picks the
largest non-null value, ascending picks a null first.

Columns under a collation compare by it. Values that are equal there may be spelled
in several ways; of rows that tie, the one whose spelling sorts first (last when
descending) stays, with its own spelling in every column, so a rerun gives the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.collation import can_fold, collated_columns, folded, spelling


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               descending: bool = False) -> DataFrame:
    """One row per ``keys``: the row that sorts first by ``order`` (all ascending,
    or all descending when ``descending``). Columns and their order are kept."""
    keys, order = list(keys), list(order)
    if collated_columns(df):
        return _keep_first_collated(df, keys, order, descending)
    rest = [c for c in df.columns if c not in keys and c not in order]
    if len(order) == 1 and not rest:
        # Only the order column is carried: a plain min/max, which for a
        # fixed-width type runs as a hash aggregate instead of a sort aggregate.
        pick = F.max(order[0]) if descending else F.min(order[0])
        return df.groupBy(*keys).agg(pick.alias(order[0])).select(*df.columns)
    packed = F.struct(*[F.col(c) for c in order + rest])
    pick = F.max(packed) if descending else F.min(packed)
    out = df.groupBy(*keys).agg(pick.alias("_tw_first"))
    return out.select(*[F.col(f"_tw_first.{c}").alias(c) if c not in keys else F.col(c)
                        for c in df.columns])


def _keep_first_collated(df: DataFrame, keys: list[str], order: list[str],
                         descending: bool) -> DataFrame:
    collated = collated_columns(df)
    fields = order + [c for c in df.columns if c not in keys and c not in order] \
        + [k for k in keys if k not in order]
    row = F.struct(*[(spelling(c) if c in collated else F.col(c)).alias(c) for c in fields])
    packed = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], row.alias("row"))
    pick = F.max(packed) if descending else F.min(packed)
    fold = collated_columns(df, keys) if can_fold(df, keys) else []
    out = df.groupBy(*[folded(k).alias(f"_tw_k{i}") if k in fold else F.col(k) for i, k in enumerate(keys)]) \
        .agg(pick.alias("_tw_first"))
    return out.select(*[F.col(f"_tw_first.row.{f.name}").cast(f.dataType).alias(f.name)
                        for f in df.schema.fields])


def keep_first_window(df: DataFrame, keys: Sequence[str], order) -> DataFrame:
    """Reference form of ``keep_first`` with ``row_number() = 1`` (mixed
    directions allowed). Kept for tests and for orders ``keep_first`` cannot
    express; Spark plans a ``WindowGroupLimit`` for it."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_tw_rn", F.row_number().over(w)).where("_tw_rn = 1").drop("_tw_rn")


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Whole-row dedupe (E4): a hash aggregate on every column, with partial
    aggregation before the shuffle."""
    if collated_columns(df):
        return keep_first(df, df.columns, [])
    return df.dropDuplicates()
