"""Aggregate-level helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.collation import collated_columns, folded, spelling
from tidewater.functions.numeric import pct


def group_by(df: DataFrame, keys: Sequence[str], *aggregates: Column, fold: bool = False) -> DataFrame:
    """``df.groupBy(*keys).agg(*aggregates)``. A group of values that only a collation
    makes equal is shown in the spelling of one of its rows, the one that sorts
    first by its characters, instead of whichever came first. ``fold`` groups them by
    their folded text; ask ``can_fold`` of the tables that the keys come from."""
    keys = list(keys)
    collated = collated_columns(df, keys)
    if not collated:
        return df.groupBy(*keys).agg(*aggregates)
    first = F.min(F.struct(*[spelling(k).alias(k) for k in collated]))
    by = [folded(k).alias(f"_tw_k{i}") if fold and k in collated else F.col(k) for i, k in enumerate(keys)]
    g = df.groupBy(*by).agg(first.alias("_tw_as"), *aggregates)
    return g.select(*[F.col(f"_tw_as.{k}").cast(df.schema[k].dataType).alias(k) if k in collated else F.col(k)
                      for k in keys], *[c for c in g.columns[len(keys):] if c != "_tw_as"])


def percent_of_total(grouped: DataFrame, count_col: str, out_col: str,
                     scale: int = 2) -> DataFrame:
    """``ROUND(n * 100.0 / SUM(n) OVER (), 2)`` on an already aggregated frame.

    Only for frames whose row count is bounded by a small label domain (a CASE
    with a few outcomes): the empty ``OVER ()`` runs in one task, which is fine
    for three rows and wrong for a frame that grows with the data."""
    total = F.sum(count_col).over(Window.partitionBy())
    return grouped.withColumn(out_col, pct(F.col(count_col), total, scale))
