"""Numeric aggregate helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions._col import as_col


def int_avg(c) -> Column:
    """Average of an integer column with an integer result, truncated toward
    zero, null on empty input (D5, ledger L2). ``sum div count`` truncates
    toward zero for negatives too."""
    c = as_col(c)
    return (F.sum(c).cast("decimal(38,0)") / F.nullif(F.count(c), F.lit(0))).cast("long")


def exact_avg(c, scale: int = 6) -> Column:
    """The same average with its fraction (D5's twin column): a decimal division
    rounded half away from zero, null on empty input."""
    c = as_col(c)
    return F.round(F.sum(c).cast("decimal(32,0)") / F.nullif(F.count(c), F.lit(0)).cast("decimal(20,0)"),
                   scale).cast(f"decimal(38,{scale})")


def round_avg(c, scale: int = 2) -> Column:
    """``ROUND(AVG(x), 2)`` on a decimal column, half away from zero."""
    return F.round(F.avg(as_col(c)), scale)


def pct(numerator: Column, denominator: Column, scale: int = 2) -> Column:
    """``ROUND(n * 100.0 / d, 2)`` in decimal arithmetic (H20, L6); null when d is 0."""
    return F.round(numerator.cast("decimal(38,6)") * F.lit(100)
                   / F.nullif(denominator, F.lit(0)).cast("decimal(38,6)"), scale)
