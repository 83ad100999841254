"""Versioned tables: failed loads, readers that hold a version, one scan a load."""

import re
import tempfile

import pytest
from pyspark.sql import functions as F

from tidewater.schemas import BRONZE
from tidewater.sources import LoadAudit, SnapshotTable, read_table
from tidewater.sources.audit import RejectLimitExceeded
from tidewater.sources.files import CORRUPT, scan_delimited
from tidewater.sources.snapshots import ConcurrentLoad


@pytest.fixture
def table(spark):
    return SnapshotTable(spark, tempfile.mkdtemp(prefix="tw-test-") + "/t")


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_readers_hold_their_version(spark, table):
    first = table.replace(spark.range(3))
    second = table.replace(spark.range(5))
    assert ids(first) == [0, 1, 2] and ids(second) == list(range(5)) == ids(table.read())
    assert ids(table.read(1)) == [0, 1, 2] and table.numbers() == [1, 2]
    assert table.version().rows == 5 and ids(read_table(spark, table.path)) == list(range(5))


def test_a_load_that_fails_halfway_leaves_the_table(spark, table):
    table.replace(spark.range(4))
    broken = spark.range(100).select(F.when(F.col("id") == 90, F.raise_error(F.lit("boom")))
                                     .otherwise(F.col("id")).cast("long").alias("id"))
    audit = LoadAudit()
    with pytest.raises(Exception, match="boom"):
        audit.load("bronze", "t", table, lambda: broken)
    assert ids(table.read()) == [0, 1, 2, 3] and table.numbers() == [1]
    assert audit.rows[0][-2] == "failed" and audit.loaded() == set()
    audit.load("bronze", "t", table, lambda: spark.range(2))
    assert ids(table.read()) == [0, 1] and audit.loaded() == {("bronze", "t")}


def test_a_written_version_is_not_seen_before_it_is_published(spark, table):
    table.replace(spark.range(1))
    written = table.write(spark.range(7))
    assert ids(table.read()) == [0]
    table.discard(written)
    table.vacuum(keep=1)
    assert ids(table.read()) == [0]


def test_rows_and_rejects_of_one_write(spark, table):
    df = spark.createDataFrame([(1, None), (2, "raw 2"), (3, None)], "id int, bad string")
    version = table.publish(table.write(df, ["id"], "bad"))
    assert (version.rows, version.rejected) == (2, 1)
    assert ids(table.read()) == [1, 3]
    assert [tuple(r) for r in table.rejects().collect()] == [("raw 2", 2)]
    assert spark.read.parquet(table.rows_folder()).count() == 2


def test_nothing_to_load(spark, table):
    df = spark.createDataFrame([], "id int, bad string")
    table.publish(table.write(df, ["id"], "bad"))
    assert table.read().count() == 0 and table.rejects().count() == 0
    assert table.read().columns == ["id"]
    assert SnapshotTable(spark, table.path + "-none").version() is None
    with pytest.raises(FileNotFoundError):
        SnapshotTable(spark, table.path + "-none").read()


def test_vacuum_keeps_the_last_versions(spark, table):
    for n in range(1, 5):
        table.replace(spark.range(n))
    table.write(spark.range(9))         # of a load that never published
    table.vacuum(keep=2)
    assert table.numbers() == [3, 4] and len(table._list("data")) == 2
    assert ids(table.read(3)) == [0, 1, 2]


def test_two_writers(spark, table, monkeypatch):
    written = table.write(spark.range(2))
    table.replace(spark.range(1))
    monkeypatch.setattr(table, "numbers", lambda: [])       # saw the table before the other's load
    with pytest.raises(ConcurrentLoad):
        table.publish(written)


def test_a_load_scans_its_source_once(spark, table):
    root = tempfile.mkdtemp(prefix="tw-test-")
    with open(f"{root}/p.csv", "w") as f:
        f.write("order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
                "a,1,boleto,1,10.50\nb,x,boleto,1,1.00\nc\n")
    schema = BRONZE["finance_ord_payments"]
    source = scan_delimited(spark, root, schema)
    wrote = []
    write = table.write
    table.write = lambda df, *a: wrote.append(df) or write(df, *a)
    audit = LoadAudit()
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("one-load", "one load")
    out = audit.load("bronze", "p", table, lambda: source, schema.fieldNames(), CORRUPT)
    assert len(status.getJobIdsForGroup("one-load")) == 1       # the write; no counting jobs
    spark.sparkContext._jsc.clearJobGroup()
    plan = wrote[0]._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("FileScan csv", plan)) == 1
    assert [r.order_id for r in out.collect()] == ["a"]
    assert sorted(r.value for r in table.rejects().collect()) == ["b,x,boleto,1,1.00", "c"]
    assert audit.rows[0][2:4] == (1, 2)


def test_reject_limit_keeps_the_old_rows(spark, table):
    audit = LoadAudit()
    df = spark.createDataFrame([(1, None), (2, "raw")], "id int, bad string")
    audit.load("bronze", "t", table, lambda: df.where("id = 1"), ["id"], "bad", 0)
    with pytest.raises(RejectLimitExceeded):
        audit.load("bronze", "t", table, lambda: df, ["id"], "bad", 0)
    assert ids(table.read()) == [1] and len(table._list("data")) == 1
