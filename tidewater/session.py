"""Session construction and the shared staging folder.

Anything that must be materialised to cut lineage (the global row number,
file round-trips of the bronze loaders) goes below ``spark.checkpoint.dir``,
the shared folder the cluster names. We only invent one when the session has
none *and* runs in local mode (tests); on a cluster a missing setting is an
error rather than a silent machine-local folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_STAGE_SUBDIR = "tidewater-stage"
#: Spark's setting by which an execution's shuffle files go when it ends.
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: What was staged within the innermost ``staging_dropped``.
_STAGED: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def build_session(master: str | None = None, app: str = "tidewater",
                  shuffle_partitions: int | None = None,
                  driver_memory: str | None = None) -> SparkSession:
    """A session for this library: AQE on, UTC, no UI. Master, shuffle
    partitions and memory are the cluster's unless given here."""
    builder = (
        SparkSession.builder
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # rows and rejects are dealt to two files a task without sorting them first
        .config("spark.sql.maxConcurrentOutputFileWriters", "8")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; set one only for local sessions."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) before running jobs that stage data")
    root = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root


def package_on_workers(spark: SparkSession) -> None:
    """Python workers import this package from where the driver did. On a
    cluster where they can't, ship it with --py-files."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def _stage_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/{_STAGE_SUBDIR}/{spark.sparkContext.applicationId}"


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder of this application under the shared checkpoint root."""
    path = f"{_stage_root(spark)}/{name}-{uuid.uuid4().hex}"
    if (staged := _STAGED.get()) is not None:
        staged.append(path)
    return path


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what is written within are removed when the write ends.
    Otherwise Spark keeps them until the driver's garbage collection finds them unused,
    and a job of many writes has those of all of them on its disks."""
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLE_CLEANUP)
        else:
            spark.conf.set(_SHUFFLE_CLEANUP, before)


def staged(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to a folder (of ``staging_path``) and read back from it."""
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession, path: str) -> None:
    """Remove a staged table that nothing will read again."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def staging_dropped(spark: SparkSession) -> Iterator[None]:
    """What is staged within is removed at the end: for work whose results are then
    written elsewhere."""
    token = _STAGED.set([])
    try:
        yield
    finally:
        paths = _STAGED.get()
        _STAGED.reset(token)
        for path in paths:
            drop_staged(spark, path)


def clear_staging(spark: SparkSession) -> None:
    """Remove what this application staged. Call it when the results are
    written: frames that read staged tables don't work afterwards."""
    drop_staged(spark, _stage_root(spark))
