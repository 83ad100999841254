"""Text under a collation (ledger L1).

The source compares and groups text by its server's default collation, under which
``abc``, ``ABC`` and ``abc  `` are one value. Columns of a collated string type make
Spark's own equality, grouping, joins and order do the same.

Comparing by the collation is costly: every comparison of a sort asks the collator, which
serves one task of an executor at a time. Among texts of printable ASCII (ids, as a
rule) the source's collation is exactly equality of ``folded`` text, which is hashed and
compared by its bytes. ``is_plain`` says whether that holds for whole columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from tidewater.functions._col import as_col

#: Case- and trailing-blank-insensitive, accent-sensitive.
SOURCE_COLLATION = "UNICODE_CI_RTRIM"


def is_collated(t: DataType) -> bool:
    return isinstance(t, StringType) and t.collation != "UTF8_BINARY"


def collated_columns(df: DataFrame, columns=None) -> list[str]:
    """Those of ``columns`` (by default all) that compare by a collation."""
    wanted = df.columns if columns is None else columns
    return [f.name for f in df.schema.fields if f.name in wanted and is_collated(f.dataType)]


def collate(df: DataFrame, collation: str | None = SOURCE_COLLATION) -> DataFrame:
    """``df`` with its text columns under ``collation``; None leaves them binary."""
    if collation is None:
        return df
    return df.select(*[F.col(f.name).cast(StringType(collation)).alias(f.name)
                       if isinstance(f.dataType, StringType) else F.col(f.name)
                       for f in df.schema.fields])


def spelling(c) -> Column:
    """A text by its characters, whatever its collation."""
    return as_col(c).cast(StringType())


#: A character beyond printable ASCII: control characters are ignored by the collation,
#: and others may equal ASCII ones (full-width letters, ligatures).
_ODD = r"[^\x20-\x7E]"


def folded(c) -> Column:
    """A text of printable ASCII as binary text that is equal exactly where the source's
    collation makes the texts equal. It says nothing about other texts: ask ``can_fold``."""
    return F.lower(F.rtrim(spelling(c)))


def is_plain(df: DataFrame, columns) -> bool:
    """Whether the texts of ``columns`` are printable ASCII alone, in one pass over them."""
    odd = [F.coalesce(F.bool_or(spelling(c).rlike(_ODD)), F.lit(False)) for c in columns]
    return not any(df.agg(*[o.alias(f"_{i}") for i, o in enumerate(odd)]).first()) if odd else True


def can_fold(df: DataFrame, columns, source: DataFrame | None = None) -> bool:
    """Whether all ``columns`` that are collated have the source's collation and plain
    texts. ``source`` has the same columns, or their texts before characters were
    removed, by a shorter way."""
    own = collated_columns(df, columns)
    return (bool(own) and all(df.schema[c].dataType.collation == SOURCE_COLLATION for c in own)
            and is_plain(df if source is None else source, own))
