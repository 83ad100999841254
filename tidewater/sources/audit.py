"""Load audit (A9) and error capture (A10).

Each load is one action; the audit keeps one row per table load with its
timing and outcome. A failed load is recorded and then re-raised, so a
partial batch is visible but never silent.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from tidewater.sources.snapshots import Buckets, SnapshotTable

AUDIT_SCHEMA = ("layer string, table_name string, row_count long, rejected long, "
                "started timestamp_ntz, ended timestamp_ntz, seconds double, "
                "status string, error string")


class RejectLimitExceeded(RuntimeError):
    pass


@dataclass
class LoadAudit:
    rows: list = field(default_factory=list)

    def run(self, layer: str, table: str, load: Callable[[], DataFrame],
            rejects: Callable[[int], int] | None = None,
            max_rejects: int | None = None) -> DataFrame:
        """Run ``load`` (which writes and returns the written table), record it.
        ``rejects`` maps the written row count to the number of rejected
        records; more than ``max_rejects`` of them fails the load (recorded,
        then raised), like a bulk load's error limit (ledger L27)."""
        def counted():
            out = load()
            n = out.count()
            return out, n, rejects(n) if rejects else 0
        return self._recorded(layer, table, counted, max_rejects)

    def load(self, layer: str, table: str, target: SnapshotTable,
             source: Callable[[], DataFrame | tuple[DataFrame, Buckets | None]],
             columns=None, corrupt: str | None = None, max_rejects: int | None = None) -> DataFrame:
        """Load ``source`` into ``target`` in one pass: rows and rejects (by the
        column ``corrupt``) are written and counted by one job. Past ``max_rejects``,
        or on any error, the target keeps its version; the failure is recorded,
        then raised. ``source`` may give with the rows how they are dealt."""
        def landed():
            given = source()
            df, buckets = given if isinstance(given, tuple) else (given, None)
            written = target.write(df, columns, corrupt, buckets)
            bad = written.rejected or 0
            try:
                self._within(layer, table, bad, max_rejects)
            except RejectLimitExceeded:
                target.discard(written)
                raise
            return target.read(target.publish(written).number), written.rows, bad
        return self._recorded(layer, table, landed, max_rejects)

    @staticmethod
    def _within(layer, table, bad, max_rejects) -> None:
        if max_rejects is not None and bad > max_rejects:
            raise RejectLimitExceeded(f"{layer}.{table}: {bad} rejected records > {max_rejects}")

    def _recorded(self, layer, table, load, max_rejects) -> DataFrame:
        started = datetime.now(timezone.utc).replace(tzinfo=None)
        t0 = time.perf_counter()
        try:
            out, n, bad = load()
            self._within(layer, table, bad, max_rejects)
        except Exception as exc:
            self._add(layer, table, None, None, started, t0, "failed", f"{type(exc).__name__}: {exc}")
            raise
        self._add(layer, table, n, bad, started, t0, "ok", None)
        return out

    def loaded(self) -> set[tuple[str, str]]:
        """The tables (layer, table) whose last load went well."""
        last = {(r[0], r[1]): r[-2] for r in self.rows}
        return {k for k, status in last.items() if status == "ok"}

    def _add(self, layer, table, n, bad, started, t0, status, error):
        ended = datetime.now(timezone.utc).replace(tzinfo=None)
        self.rows.append((layer, table, n, bad, started, ended,
                          round(time.perf_counter() - t0, 3), status, error))

    def to_df(self, spark: SparkSession) -> DataFrame:
        """One row per load; the list is bounded by the number of tables."""
        return spark.createDataFrame(self.rows, AUDIT_SCHEMA)
