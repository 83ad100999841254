"""Key maps: keys stay, new members get the next ones, gold builds keep them."""

import tempfile

import pytest

from tidewater.operators import extend_key_map, with_keys
from tidewater.plans import gold
from tidewater.plans.warehouse import GoldBuild, Warehouse, build_gold
from tidewater.sources import SnapshotTable, read_table

SF = "/root/testdata/sf0.001"


@pytest.fixture
def key_map(spark):
    return SnapshotTable(spark, tempfile.mkdtemp(prefix="tw-test-") + "/map")


def members(spark, *names):
    return spark.createDataFrame([(n, 1) for n in names], "name string, key int").select("name")


def pairs(df):
    return {r.name: r.k for r in df.collect()}


def test_new_members_get_the_next_keys(spark, key_map):
    assert pairs(extend_key_map(key_map, members(spark, "d", "b", "b"), ["name"], "k")) == {"b": 1, "d": 2}
    later = pairs(extend_key_map(key_map, members(spark, "a", "d", "c", None), ["name"], "k"))
    assert later == {"b": 1, "d": 2, None: 3, "a": 4, "c": 5}
    again = pairs(extend_key_map(key_map, members(spark, "c", None), ["name"], "k"))
    assert again == later and key_map.numbers() == [1, 2]       # nothing new, nothing written


def test_composite_keys_with_nulls(spark, key_map):
    df = spark.createDataFrame([(1, None), (1, "x"), (None, "x")], "a int, b string")
    got = extend_key_map(key_map, df, ["a", "b"], "k")
    assert sorted(r.k for r in got.collect()) == [1, 2, 3]
    more = spark.createDataFrame([(None, None), (1, None)], "a int, b string")
    after = extend_key_map(key_map, more, ["a", "b"], "k")
    assert {(r.a, r.b): r.k for r in after.collect()}[None, None] == 4
    keyed = with_keys(more.withColumnRenamed("b", "b"), after, ["a", "b"], "k")
    assert keyed.columns == ["k", "a", "b"] and keyed.count() == 2


def test_gold_builds_keep_their_keys(spark):
    root = tempfile.mkdtemp(prefix="tw-test-")
    wh = Warehouse(spark, SF)
    silver = f"{root}/silver"
    names = ("crm_cust_info", "crm_cust_reviews", "finance_ord_payments", "prd_seller_details",
             "prd_item_details", "prd_translations", "reference_geolocation", "sales_ord_items",
             "sales_ord_details")
    few = {"crm_cust_info": "NOT customer_unique_id LIKE '%5'", "prd_item_details": "NOT product_id LIKE '%5'",
           "sales_ord_details": "NOT order_id LIKE '%5'"}
    for name in names:
        df = wh.silver(name)
        SnapshotTable(spark, f"{silver}/{name}").replace(df.where(few[name]) if name in few else df)
    build_gold(spark, silver, f"{root}/gold", views=False)
    first = {m: read_table(spark, f"{root}/gold/{m}").collect()
             for m in ("dim_customer", "dim_products", "fact_sales", "fact_sales_items")}
    for name in few:
        SnapshotTable(spark, f"{silver}/{name}").replace(wh.silver(name))
    build_gold(spark, silver, f"{root}/gold", views=False)
    for model, natural, key in (("dim_customer", "customer_unique_id", "customer_key"),
                                ("dim_products", "product_id", "product_key"),
                                ("fact_sales", "order_id", "order_key")):
        before = {r[natural]: r[key] for r in first[model]}
        after = {r[natural]: r[key] for r in read_table(spark, f"{root}/gold/{model}").collect()}
        assert len(after) > len(before) and before.items() <= after.items()
        assert sorted(after.values()) == list(range(1, len(after) + 1))
    # the item fact carries the dimensions' keys, and the text key the same number
    items = read_table(spark, f"{root}/gold/fact_sales_items")
    assert items.where("customer_key != concat('CUST', customer_sk)").count() == 0
    dims = read_table(spark, f"{root}/gold/dim_products").selectExpr("product_key AS product_sk", "product_id")
    known = items.where("product_sk IS NOT NULL").join(dims, "product_sk")
    assert known.count() == items.where("product_sk IS NOT NULL").count() > 0
    assert known.where("product_key != concat('PRD', product_id)").count() == 0
    old = {(r.order_id, r.order_item_id): r.sales_key for r in first["fact_sales_items"]}
    new = {(r.order_id, r.order_item_id): r.sales_key for r in items.collect()}
    assert old.items() <= new.items()
    assert gold.dim_customer(GoldBuild(spark, silver, f"{root}/gold"), keyed=False).count() > 0
