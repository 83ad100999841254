"""Surrogate keys that stay with their members from load to load (E6, ledger L12).

The source numbers its dimensions on every read, so a new member shifts the keys
of all behind it. A key map keeps what was given: members that it has keep
their keys, new ones are found by an anti-join and numbered from the last key on,
in the order of their natural key. A first load gives the keys of
``global_row_number``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.ranking import global_row_number
from tidewater.sources.snapshots import SnapshotTable


def _same(left: DataFrame, right: DataFrame, natural: Sequence[str]) -> Column:
    on = F.lit(True)
    for c in natural:
        on = on & left[c].eqNullSafe(right[c])
    return on


def extend_key_map(table: SnapshotTable, members: DataFrame, natural: Sequence[str],
                   key: str) -> DataFrame:
    """The map (``natural``, ``key``) after the members of ``members`` were added.
    Nulls are values like any other. Without new members nothing is written."""
    wanted = members.select(*natural).distinct()
    if table.version() is None:
        return table.replace(global_row_number(wanted, list(natural), key), [*natural, key])
    known = table.read()
    fresh = wanted.join(known, _same(wanted, known, natural), "left_anti")
    numbered = global_row_number(fresh, list(natural), key)     # written, so counted once
    if numbered.isEmpty():
        return known
    last = known.agg(F.max(key)).first()[0]
    numbered = numbered.withColumn(key, F.col(key) + F.lit(last))
    return table.replace(known.unionByName(numbered.select(*natural, key)), [*natural, key])


def with_keys(df: DataFrame, key_map: DataFrame, natural: Sequence[str], key: str) -> DataFrame:
    """``df`` with ``key``, its first column, from the map."""
    joined = df.join(key_map, _same(df, key_map, natural))
    return joined.select(key_map[key], *[df[c] for c in df.columns])
