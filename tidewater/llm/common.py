"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import staging_path

#: White space of every contract of this package (one character of the class).
SPACE_CHARS = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Rows handed to a Python helper at a time, so that the Python objects of a
#: batch stay small next to its Arrow buffers.
SLICE_ROWS = 128
#: Bytes of text handed to Arrow's functions at a time.
SLICE_BYTES = 8 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under ``spark.checkpoint.dir`` and read it back: the
    lineage is cut by a table that every executor can read again."""
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(col: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def text_bytes(col: str = "text") -> Column:
    """UTF-8 of the text, null as empty."""
    return whole_text(col).cast("binary")


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text modulo ``folds``; a null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(folds)


def slices(batch: pa.RecordBatch, rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def text_slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Slices with about ``SLICE_BYTES`` of binary ``column`` each, a row at least."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy().astype(np.int64))
    at = 0
    while at < batch.num_rows:
        most = SLICE_BYTES + (ends[at - 1] if at else 0)
        until = max(at + 1, int(np.searchsorted(ends, most, "right")))
        yield batch.slice(at, until - at)
        at = until


def splitmix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, elementwise on uint64 (wrapping)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def picked_rows(rows: DataFrame, most: int, n: int) -> DataFrame:
    """About ``most`` of the ``n`` ``rows`` (doc_id, text), by a hash of both, each
    distinct one once: neither null or repeated ids nor copies make it more."""
    share = int((1 << 30) * min(1.0, most / max(n, 1)))
    chosen = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < share)
    return (chosen.groupBy("doc_id", F.xxhash64("text").alias("_h"))
            .agg(F.first("text").alias("text")).select("doc_id", "text"))
