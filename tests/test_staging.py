"""What a job has on its disks: shuffle files and staged tables go when they were read."""

import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from tidewater import session
from tidewater.plans import gold, registry, warehouse
from tidewater.sources import Buckets, SnapshotTable, read_table

DATES = ("order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
         "order_delivered_customer_date")


def silver_tables(spark):
    return {
        "sales_ord_items": spark.createDataFrame(
            [("1", 1, "a", "s", None, None, None), ("1", 2, "b", "none", None, None, None),
             ("2", 1, "none", "s", None, None, None), (None, 1, "a", None, None, None, None),
             ("3", 1, None, "s", None, None, None)],
            "order_id string, order_item_id int, product_id string, seller_id string, "
            "shipping_limit_date timestamp, price decimal(10,2), freight_value decimal(10,2)"),
        "sales_ord_details": spark.createDataFrame(
            [("1", "c2", "Shipped", *[None] * 5), ("2", None, "Invoiced", *[None] * 5)],
            "order_id string, customer_id string, order_status string, "
            + ", ".join(f"{d} timestamp" for d in DATES) + ", order_estimated_delivery_date date"),
        "crm_cust_info": spark.createDataFrame([("c1", "u1"), ("c2", "u2"), ("c4", None)],
                                               "customer_id string, customer_unique_id string"),
        "prd_item_details": spark.createDataFrame([("a",), ("b",), ("b",)], "product_id string"),
        "prd_seller_details": spark.createDataFrame([("s",)], "seller_id string")}


def shuffle_files(spark) -> set[str]:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in found.mkString("\n").split("\n") if "shuffle_" in f}


def new_shuffle_files(spark, before) -> set[str]:
    """Those that stay: Spark removes them a moment after the write."""
    for _ in range(100):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    return shuffle_files(spark) - before


@pytest.fixture
def staged_now(spark):
    """The names of the tables that are staged now and weren't before."""
    root = session._stage_root(spark).removeprefix("file:")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    return lambda: sorted(n.rsplit("-", 1)[0] for n in set(os.listdir(root)) - before)


def test_written_tables_keep_no_shuffle_files(spark):
    rows = spark.range(1000).repartition(3, "id")
    before, setting = shuffle_files(spark), spark.conf.get(session._SHUFFLE_CLEANUP)
    SnapshotTable(spark, tempfile.mkdtemp(prefix="tw-test-") + "/a").replace(rows)
    SnapshotTable(spark, tempfile.mkdtemp(prefix="tw-test-") + "/b").replace(rows, buckets=Buckets("id", 2))
    session.staged(rows, session.staging_path(spark, "t"))
    assert new_shuffle_files(spark, before) == set()
    assert spark.conf.get(session._SHUFFLE_CLEANUP) == setting


def test_the_item_fact_keeps_its_numbered_rows_only(spark, stub, staged_now):
    f = gold.fact_sales_items(stub(spark, silver_tables(spark)))
    assert {n for n in staged_now() if not n.startswith(("rownum-", "hot-keys"))} == set()
    assert not [n for n in staged_now() if n.startswith("rownum-input")]
    got = sorted((r.order_id or "", r.order_item_id, r.product_key or "", r.seller_key or "", r.sales_key)
                 for r in f.collect())
    # a product that is there twice makes two rows of its item
    assert [g[:4] for g in got] == [("", 1, "PRDa", ""), ("1", 1, "PRDa", "Ss"), ("1", 2, "PRDb", ""),
                                    ("1", 2, "PRDb", ""), ("2", 1, "", "Ss"), ("3", 1, "", "Ss")]
    assert sorted(g[4] for g in got) == [1, 2, 3, 4, 5, 6]


def test_one_shuffle_of_the_items_at_a_time(spark, stub, monkeypatch):
    """Each table written on the way reads the one before, through one exchange of the items."""
    plans, staged = {}, gold.staged

    def kept(df, path):
        plans[path.rsplit("/", 1)[-1].rsplit("-", 1)[0]] = df._jdf.queryExecution().optimizedPlan().toString()
        return staged(df, path)
    monkeypatch.setattr(gold, "staged", kept)
    gold.fact_sales_items(stub(spark, silver_tables(spark)), keyed=False).collect()
    assert [n for n in plans if n.startswith("items")] == ["items", "items-product_id", "items-seller_id"]
    for name in ("items-product_id", "items-seller_id"):
        assert plans[name].count("_tw_salt") and "order_status" not in plans[name]
    assert "product_id" in plans["items-product_id"] and "seller_key" not in plans["items-product_id"]


def test_bucketed_items_are_dealt_again(spark, stub):
    tables = silver_tables(spark)
    plain = stub(spark, tables)
    dealt = stub(spark, tables)
    items = SnapshotTable(spark, tempfile.mkdtemp(prefix="tw-test-") + "/items")
    dealt._silver = tables | {"sales_ord_items": items.replace(tables["sales_ord_items"], buckets=Buckets("order_id", 3))}
    dealt.materialized = True
    dealt.buckets = lambda name: items.version().buckets if name == "sales_ord_items" else None

    def rows(wh):
        return sorted(map(str, gold.fact_sales_items(wh, keyed=False).collect()))
    assert rows(dealt) == rows(plain) and len(rows(dealt)) == 6


def test_staging_dropped_leaves_what_was_there(spark):
    kept = session.staging_path(spark, "kept")
    session.staged(spark.range(3), kept)
    with session.staging_dropped(spark):
        inner = session.staging_path(spark, "inner")
        session.staged(spark.range(3), inner)
        with pytest.raises(ZeroDivisionError), session.staging_dropped(spark):
            innermost = session.staging_path(spark, "innermost")
            session.staged(spark.range(3).where(F.col("id") > 0), innermost)
            raise ZeroDivisionError
        assert not os.path.exists(innermost.removeprefix("file:"))
        assert os.path.exists(inner.removeprefix("file:"))
    assert not os.path.exists(inner.removeprefix("file:")) and spark.read.parquet(kept).count() == 3


def customers(spark, *ids):
    return spark.createDataFrame([(f"c{i}", u, "z", "City", "st") for i, u in enumerate(ids)],
                                 "customer_id string, customer_unique_id string, customer_zip_code string, "
                                 "customer_city string, customer_state string")


def test_gold_builds_leave_nothing_staged(spark, monkeypatch, staged_now):
    monkeypatch.setattr(warehouse, "GOLD_MODELS", ("dim_customer",))
    root = tempfile.mkdtemp(prefix="tw-test-")
    silver = SnapshotTable(spark, f"{root}/silver/crm_cust_info")
    session.staged(spark.range(1), session.staging_path(spark, "other"))
    for ids, keys in ((("u3", "u1", None, "u1"), {None: 1, "u1": 2, "u3": 3}),
                      (("u2", "u3", "u1", None), {None: 1, "u1": 2, "u3": 3, "u2": 4})):
        silver.replace(customers(spark, *ids))
        warehouse.build_gold(spark, f"{root}/silver", f"{root}/gold", views=False)
        built = read_table(spark, f"{root}/gold/dim_customer")
        assert {r.customer_unique_id: r.customer_key for r in built.collect()} == keys
        assert built.columns[0] == "customer_key" and staged_now() == ["other"]
        kept = read_table(spark, f"{root}/gold/_keys/dim_customer")
        assert {r.customer_unique_id: r.customer_key for r in kept.collect()} == keys


def test_deliveries_go_when_they_are_loaded(spark, monkeypatch):
    class Loaded(Exception):
        pass

    seen = []

    def export(wh, src):
        os.makedirs(src.removeprefix("file:"))
        seen.append(src.removeprefix("file:"))

    def load_silver(*_):
        raise Loaded([os.path.isdir(s) for s in seen])
    monkeypatch.setattr(warehouse, "export_sources", export)
    monkeypatch.setattr(warehouse, "load_bronze", lambda _spark, src, _bronze: seen.append(src.removeprefix("file:")))
    monkeypatch.setattr(warehouse, "load_silver", load_silver)
    with pytest.raises(Loaded, match="False, False"):
        registry.QUERIES["a8_published_layers"](spark, "/nowhere")
    assert seen[0] == seen[1]
