"""Tables as versioned folders with a manifest that is switched last.

    <table>/data/<id>/...          the files of one version
    <table>/_versions/00000001.json    its manifest: folder, schema, counts

A load writes a folder of its own and only then adds the next manifest, one small
file put in place by a rename. So a load that fails at any point leaves the table
as it was, a retry starts afresh, and a frame that was read before a load goes on
reading the version it holds. ``vacuum`` removes old versions and what failed
loads left. One writer at a time: a second one that publishes the same number
fails.

A version may be dealt into buckets (``Buckets``): one sorted file a bucket, so that
joins and aggregates on the bucketed column need no shuffle. Spark reads buckets
by catalog tables only; the session's entry for a version is made when it is first
read and names the version's folder, nothing is copied.

Rows and rejected records come from one scan of the source: a single write deals
them out by the partition column ``rejected``, and their numbers are observed
while they are written.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from tidewater.session import shuffles_dropped

#: Columns that a folder of rows and rejects has besides the table's own.
RAW, REJECTED = "_raw_record", "rejected"
COMPRESSION = "zstd"


class ConcurrentLoad(RuntimeError):
    pass


@dataclass(frozen=True)
class Buckets:
    """Rows dealt by the hash of a column into a number of buckets."""
    column: str
    number: int

    @property
    def clause(self) -> str:
        return f"CLUSTERED BY (`{self.column}`) SORTED BY (`{self.column}`) INTO {self.number} BUCKETS"


@dataclass(frozen=True)
class Dealt(Buckets):
    """Buckets of rows that come dealt into them (``repartition`` by number and column)."""


@dataclass(frozen=True)
class Version:
    """One version of a table: its number (0: not published yet), folder, schema,
    the counts observed while it was written, and its buckets if it has any."""
    number: int
    folder: str
    schema: StructType
    rows: int
    rejected: int | None = None
    buckets: Buckets | None = None


def columns_ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # --- files of the manifest, through the file system of the path -----------------
    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def _list(self, folder: str) -> list[str]:
        fs, at = self._fs(f"{self.path}/{folder}")
        return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []

    def _delete(self, path: str) -> None:
        fs, at = self._fs(path)
        fs.delete(at, True)

    def numbers(self) -> list[int]:
        """The published versions, the oldest first."""
        return [int(n[:-5]) for n in self._list("_versions") if n.endswith(".json")
                and not n.startswith(("_", "."))]

    def version(self, number: int | None = None) -> Version | None:
        """A published version, by default the current one; None without any."""
        if number is None:
            number = max(self.numbers(), default=None)
            if number is None:
                return None
        fs, at = self._fs(f"{self.path}/_versions/{number:08d}.json")
        stream = fs.open(at)
        try:
            info = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Version(number, f"{self.path}/data/{info['folder']}",
                       StructType.fromJson(info["schema"]), info["rows"], info["rejected"],
                       Buckets(**info["buckets"]) if info.get("buckets") else None)

    # --- reading --------------------------------------------------------------------
    def rows_folder(self, number: int | None = None) -> str:
        """Where the rows of a version are."""
        v = self._known(number)
        return v.folder if v.rejected is None else f"{v.folder}/{REJECTED}=false"

    def _known(self, number: int | None) -> Version:
        v = self.version(number)
        if v is None:
            raise FileNotFoundError(f"{self.path} has no published version")
        return v

    @staticmethod
    def _entry(folder: str) -> str:
        return f"default.tidewater_{folder.rsplit('/', 1)[-1]}"

    def _enter(self, folder: str, schema: StructType, buckets: Buckets) -> str:
        """The session's catalog entry of a bucketed folder."""
        name = self._entry(folder)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns_ddl(schema)}) USING parquet "
                       f"OPTIONS (compression '{COMPRESSION}') {buckets.clause} LOCATION '{folder}'")
        return name

    def _both(self, v: Version) -> DataFrame:
        full = StructType([*v.schema.fields, StructField(RAW, StringType()),
                           StructField(REJECTED, BooleanType())])
        return self.spark.read.schema(full).parquet(v.folder)

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of a version, by default of the one that is current now."""
        v = self._known(number)
        if v.buckets is not None:
            return self.spark.table(self._enter(v.folder, v.schema, v.buckets))
        if v.rejected is None:
            return self.spark.read.schema(v.schema).parquet(v.folder)
        return self._both(v).where(~F.col(REJECTED)).select(*v.schema.fieldNames())

    def rejects(self, number: int | None = None) -> DataFrame:
        """The rejected records of a version: the raw record as ``value`` and the
        fields that could be read."""
        v = self._known(number)
        names = v.schema.fieldNames()
        if v.rejected is None:
            return self.read(v.number).limit(0).select(
                F.lit(None).cast("string").alias("value"), *names)
        return self._both(v).where(F.col(REJECTED)).select(F.col(RAW).alias("value"), *names)

    # --- loading --------------------------------------------------------------------
    def write(self, df: DataFrame, columns=None, corrupt: str | None = None,
              buckets: Buckets | None = None) -> Version:
        """Write a version's files without publishing them. ``corrupt`` names the
        column that holds the raw record of rows to reject. Counts are observed by
        the same job. ``buckets`` (of a table without rejects) deals the rows by the
        hash that Spark's shuffles use, so a bucket is one file; a value with a large
        share of the rows would be one task's work, so ask ``even_buckets`` before.
        Rows that are dealt already (``Dealt``) aren't shuffled again."""
        with shuffles_dropped(self.spark):
            return self._write(df, columns, corrupt, buckets)

    def _write(self, df: DataFrame, columns, corrupt: str | None, buckets: Buckets | None) -> Version:
        folder, seen = uuid.uuid4().hex, Observation()
        names = list(columns or [c for c in df.columns if c != corrupt])
        own = df.select(*names)
        at = f"{self.path}/data/{folder}"
        if buckets is not None:
            if corrupt is not None:
                raise ValueError("a table with rejects can't be bucketed")
            if not isinstance(buckets, Dealt):
                own = own.repartition(buckets.number, buckets.column)
            buckets = Buckets(buckets.column, buckets.number)
            name = self._enter(at, own.schema, buckets)
            try:
                (own.observe(seen, F.count(F.lit(1)).alias("rows")).write.insertInto(name))
            except Exception:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
                raise
            return Version(0, at, own.schema, seen.get["rows"], None, buckets)
        if corrupt is None:
            (own.observe(seen, F.count(F.lit(1)).alias("rows"))
             .write.option("compression", COMPRESSION).parquet(at))
            return Version(0, at, own.schema, seen.get["rows"])
        wrong = F.col(corrupt).isNotNull()
        (df.select(*names, F.col(corrupt).alias(RAW), wrong.alias(REJECTED))
         .observe(seen, F.count_if(~F.col(REJECTED)).alias("rows"),
                  F.count_if(F.col(REJECTED)).alias("rejected"))
         .write.option("compression", COMPRESSION).partitionBy(REJECTED).parquet(at))
        return Version(0, at, own.schema, seen.get["rows"], seen.get["rejected"])

    def publish(self, written: Version) -> Version:
        """Make a written version the current one."""
        number = max(self.numbers(), default=0) + 1
        text = json.dumps({"folder": written.folder.rsplit("/", 1)[-1],
                           "schema": written.schema.jsonValue(),
                           "rows": written.rows, "rejected": written.rejected,
                           "buckets": written.buckets and asdict(written.buckets)})
        name = f"{number:08d}.json"
        fs, temporary = self._fs(f"{self.path}/_versions/_{uuid.uuid4().hex}")
        stream = fs.create(temporary)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        _, final = self._fs(f"{self.path}/_versions/{name}")
        if fs.exists(final) or not fs.rename(temporary, final):
            fs.delete(temporary, False)
            raise ConcurrentLoad(f"{self.path}: version {number} was published by another load")
        return replace(written, number=number)

    def discard(self, written: Version) -> None:
        """Remove the files of a version that isn't to be published."""
        self._remove(written.folder)

    def remove(self) -> None:
        """Remove the table with all its versions."""
        for folder in self._list("data"):
            self._remove(f"{self.path}/data/{folder}")
        self._delete(self.path)

    def _remove(self, folder: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._entry(folder)}")
        self._delete(folder)

    def replace(self, df: DataFrame, columns=None, buckets: Buckets | None = None) -> DataFrame:
        """Full refresh: write, publish, and read the new version."""
        return self.read(self.publish(self.write(df, columns, buckets=buckets)).number)

    def vacuum(self, keep: int = 2) -> None:
        """Keep the last versions; remove the others and folders of failed loads. Not
        to be called while a load runs."""
        numbers = self.numbers()
        kept = {self.version(n).folder.rsplit("/", 1)[-1] for n in numbers[-keep:]}
        for n in numbers[:-keep]:
            self._delete(f"{self.path}/_versions/{n:08d}.json")
        for folder in self._list("data"):
            if folder not in kept:
                self._remove(f"{self.path}/data/{folder}")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current rows of a snapshot table, or of a plain folder of Parquet files."""
    table = SnapshotTable(spark, path)
    return table.read() if table.numbers() else spark.read.parquet(path)
