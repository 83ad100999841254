"""Bucketed silver tables: joins and aggregates on the order id without a shuffle."""

import re
import tempfile

import pytest
from pyspark.sql import functions as F

from tidewater.operators import even_buckets, spread_evenly
from tidewater.plans import gold, silver, warehouse
from tidewater.plans.warehouse import MaterializedLayer, Warehouse, deal, load_silver
from tidewater.sources import Buckets, LoadAudit, SnapshotTable
from tidewater.sources.snapshots import Dealt

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def folder():
    return tempfile.mkdtemp(prefix="tw-test-")


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture(scope="module")
def layer(spark):
    bronze, silver = folder(), folder()
    wh, audit = Warehouse(spark, SF), LoadAudit()
    for name in ("crm_cust_info", "crm_cust_reviews", "finance_ord_payments", "prd_item_details",
                 "prd_seller_details", "prd_translations", "reference_geolocation", "sales_ord_items",
                 "sales_ord_details"):
        SnapshotTable(spark, f"{bronze}/{name}").replace(wh.bronze(name))
    load_silver(spark, bronze, silver, audit, buckets=4)
    return MaterializedLayer(spark, silver)


def test_the_order_fact_shuffles_no_order_ids(layer, no_broadcast):
    assert layer.buckets("sales_ord_items") == Buckets("order_id", 4)
    assert layer.buckets("crm_cust_info") is None
    p = plan(gold.fact_sales(layer, keyed=False))
    assert "hashpartitioning(order_id" not in p and p.count("Bucketed: true") == 4
    assert "hashpartitioning(customer_id, _tw_salt" in p


def test_the_item_fact_shuffles_the_order_side_only(layer, no_broadcast):
    p = plan(gold.fact_sales_items(layer, keyed=False))
    assert p.count("Exchange hashpartitioning(order_id, 4)") == 1
    assert re.search(r"FileScan parquet spark_catalog.default.tidewater_\w+\[order_id,order_item_id.*Bucketed: true", p)


def test_a_bucket_is_one_sorted_file(spark, layer):
    v = SnapshotTable(spark, f"{layer.root}/sales_ord_items").version()
    files = spark.read.parquet(v.folder).select(F.input_file_name().alias("f"), "order_id")
    per = files.groupBy("order_id").agg(F.count_distinct("f").alias("n"))
    assert files.select("f").distinct().count() == 4 and per.where("n > 1").isEmpty()
    assert v.rows == spark.read.parquet(v.folder).count()


def test_hot_and_null_orders_keep_a_table_plain(spark):
    rows = spark.range(600_000)
    hot = rows.select(F.when(F.col("id") % 3 == 0, "a").otherwise(F.col("id").cast("string")).alias("order_id"))
    none = rows.select(F.when(F.col("id") % 3 != 0, F.col("id").cast("string")).alias("order_id"))
    even = rows.select(F.col("id").cast("string").alias("order_id"))
    assert deal(hot, "finance_ord_payments", 16) is None and deal(none, "sales_ord_items", 16) is None
    assert deal(even, "sales_ord_items", 16) == Buckets("order_id", 16)
    assert deal(even, "crm_cust_info", 16) is None and deal(even, "sales_ord_items", 0) is None
    assert spread_evenly(hot.limit(0), "order_id", 16)


def test_failed_writes_and_old_versions_leave_no_entry(spark):
    table, of = SnapshotTable(spark, folder() + "/t"), Buckets("id", 2)
    for n in (3, 5, 7):
        assert table.replace(spark.range(n), buckets=of).count() == n
    broken = spark.range(9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("boom")))
                                   .otherwise(F.col("id")).cast("long").alias("id"))

    def entries():
        return sum(t.name.startswith("tidewater_") for t in spark.catalog.listTables("default"))

    known = entries()
    with pytest.raises(Exception, match="boom"):
        table.write(broken, buckets=of)
    assert entries() == known and table.read().count() == 7
    table.discard(table.write(spark.range(2), buckets=of))
    assert entries() == known
    table.vacuum(keep=1)
    assert entries() == known - 2 and table.numbers() == [3] and table.read().count() == 7
    with pytest.raises(ValueError):
        table.write(spark.range(1).withColumn("bad", F.lit("x")), ["id"], "bad", of)


def test_another_session_reads_the_buckets(spark):
    table = SnapshotTable(spark, folder() + "/t")
    table.replace(spark.range(10), buckets=Buckets("id", 2))
    spark.sql(f"DROP TABLE {table._entry(table.version().folder)}")      # as if never entered here
    p = plan(table.read().groupBy("id").count())
    assert "Exchange" not in p and "Bucketed: true" in p


def test_items_and_reviews_are_dealt_once(spark, layer, monkeypatch):
    """Before the dedupe, in one shuffle, and nothing is staged for it."""
    staged, plans = [], {}
    monkeypatch.setattr(warehouse, "staging_path", lambda _spark, name: staged.append(name) or folder() + "/s")
    write = SnapshotTable.write

    def kept(self, df, *a, **k):
        plans[self.path.rsplit("/", 1)[-1]] = plan(df)
        return write(self, df, *a, **k)

    monkeypatch.setattr(SnapshotTable, "write", kept)
    wh, bronze, root = Warehouse(spark, SF), folder(), folder()
    names = ("sales_ord_items", "crm_cust_reviews")
    for name in names:
        SnapshotTable(spark, f"{bronze}/{name}").replace(wh.bronze(name))
    monkeypatch.setattr(warehouse.silver_tf, "TRANSFORMS", {n: warehouse.silver_tf.TRANSFORMS[n] for n in names})
    load_silver(spark, bronze, root, buckets=4)
    assert staged == []
    for name in names:
        assert re.findall(r"Exchange (\w+\(.*?\))", plans[name]) == ["hashpartitioning(order_id, 4)"]
        table = SnapshotTable(spark, f"{root}/{name}")
        v, want = table.version(), wh.silver(name)
        assert v.buckets == Buckets("order_id", 4) and v.rows == want.count()
        assert table.read().exceptAll(want).isEmpty()
        files = spark.read.parquet(v.folder).select(F.input_file_name().alias("f"), "order_id")
        per = files.groupBy("order_id").agg(F.count_distinct("f").alias("n"))
        assert files.select("f").distinct().count() == 4 and per.where("n > 1").isEmpty()


def test_hot_orders_are_folded_before_they_are_dealt(spark):
    """A third of the items are copies in one order: no early deal, the same rows."""
    rows = spark.range(360_000).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise(F.col("id").cast("string")).alias("order_id"),
        (F.col("id") % 7).cast("int").alias("order_item_id"), F.lit("p").alias("product_id"),
        F.lit("s").alias("seller_id"), F.lit("2018-01-01 10:00:00").alias("shipping_limit_date"),
        F.lit(1).cast("decimal(10,2)").alias("price"), F.lit(1).cast("decimal(10,2)").alias("freight_value"))
    assert not even_buckets(rows, "order_id", 16)
    df, buckets = warehouse.silver_rows("sales_ord_items", rows, 16)
    assert type(buckets) is Buckets and df.count() == 240_001
    early = warehouse.silver_rows("sales_ord_items", rows.where("order_id <> 'a'"), 16)
    assert type(early[1]) is Dealt and early[0].count() == 240_000


def test_the_first_item_that_has_a_number_stays(spark):
    rows = spark.createDataFrame([("a", None), ("a", 2), ("a", 1), ("b", None), (None, 3), (None, 2)],
                                 "order_id string, order_item_id int").select(
        "*", F.lit("p").alias("product_id"), F.lit(None).cast("string").alias("seller_id"),
        F.lit("2018-01-01 10:00:00").alias("shipping_limit_date"),
        F.lit(1).cast("decimal(10,2)").alias("price"), F.lit(1).cast("decimal(10,2)").alias("freight_value"))
    df, buckets = warehouse.silver_rows("sales_ord_items", rows, 4)
    want = silver.order_items(rows)
    assert isinstance(buckets, Dealt) and df.columns == want.columns
    assert sorted(map(str, df.collect())) == sorted(map(str, want.collect()))
    assert {(r.order_id, r.order_item_id) for r in df.collect()} == {("a", 1), ("b", None), (None, 2)}
