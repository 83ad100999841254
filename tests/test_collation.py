"""Text that a collation makes equal: dedupe, grouping, hot keys, joins."""

import pytest
from pyspark.sql import functions as F

from tidewater.functions import can_fold, collate, collated_columns, folded, is_collated, is_plain, spelling
from tidewater.operators import (drop_exact_duplicates, extend_key_map, global_row_number, group_by,
                                 hot_keys, keep_first, left_join_salted)
from tidewater.plans import gold
from tidewater.plans.warehouse import deal
from tidewater.schemas import SILVER
from tidewater.sources import SnapshotTable
import tempfile


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_collate_touches_text_only(spark):
    df = spark.createDataFrame([("a", 1, None)], "k string, n int, s string")
    out = collate(df)
    assert collated_columns(out) == ["k", "s"] and not collated_columns(collate(df, None))
    assert not is_collated(out.select(spelling("k").alias("k")).schema["k"].dataType)
    assert rows(out) == rows(df)


def test_keep_first_keeps_a_row_with_its_spelling(spark):
    df = collate(spark.createDataFrame(
        [("abc", 1, "x"), ("ABC ", 2, "y"), ("Abc", 2, "Y"), (None, 3, "z"), (None, 4, "z "), ("d", 0, None)],
        "k string, n int, v string"))
    got = keep_first(df, ["k"], ["n"], descending=True)
    # n = 2 twice: the later spelling of (n, v, k)
    assert rows(got) == rows(spark.createDataFrame([("ABC ", 2, "y"), (None, 4, "z "), ("d", 0, None)], df.schema))
    assert got.schema == df.schema
    assert rows(keep_first(df, ["k"], ["n"])) == [("abc", 1, "x"), ("d", 0, None), (None, 3, "z")]


def test_exact_duplicates_and_groups_show_the_first_spelling(spark):
    data = [("b", 1), ("B", 1), ("b  ", 1), ("b", 2), (None, 1), (None, 1)]
    for order in (data, data[::-1]):
        df = collate(spark.createDataFrame(order, "k string, n int"))
        assert rows(drop_exact_duplicates(df)) == rows(spark.createDataFrame([("B", 1), ("b", 2), (None, 1)], df.schema))
        got = group_by(df, ["k"], F.sum("n").alias("n"))
        assert rows(got) == [("B", 5), (None, 2)] and is_collated(got.schema["k"].dataType)
    plain = spark.createDataFrame(data, "k string, n int")
    assert drop_exact_duplicates(plain).count() == 5 and group_by(plain, ["k"], F.count("n")).count() == 4


def test_hot_keys_in_several_spellings_are_one(spark):
    spelled = F.when(F.col("id") % 4 == 0, F.when(F.col("id") % 8 == 0, "hot").otherwise("HOT  ")) \
        .otherwise(F.concat(F.lit("c"), F.col("id").cast("string")))
    df = collate(spark.range(20_000).select(spelled.alias("k"), "id"))
    hot = hot_keys(df, ["k"], partitions=32, min_hot_rows=100)["k"]
    assert [r.k.rstrip().lower() for r in hot.collect()] == ["hot"]
    right = collate(spark.createDataFrame([("Hot", 1), ("c1", 2)], "k string, v int"))
    joined = left_join_salted(df, right, "k", hot, salt_from="id", salts=4)
    assert [tuple(r) for r in joined.groupBy("v").count().orderBy("v").collect()] == \
        [(None, 14_999), (1, 5_000), (2, 1)]


def test_numbers_and_key_maps_under_a_collation(spark):
    members = collate(spark.createDataFrame([("b",), ("A",), ("c",)], "k string"))
    assert [(r.k, r.n) for r in global_row_number(members, ["k"], "n").orderBy("n").collect()] == \
        [("A", 1), ("b", 2), ("c", 3)]
    table = SnapshotTable(spark, tempfile.mkdtemp(prefix="tw-test-") + "/m")
    extend_key_map(table, members, ["k"], "n")
    more = collate(spark.createDataFrame([("B  ",), ("d",), ("a",)], "k string"))
    assert rows(extend_key_map(table, more, ["k"], "n").select(F.lower("k"), "n")) == \
        [("a", 1), ("b", 2), ("c", 3), ("d", 4)]


def test_collated_keys_are_not_bucketed(spark):
    assert deal(collate(spark.createDataFrame([("a",)], "order_id string")), "sales_ord_items", 4) is None


def test_folded_text_is_equal_where_the_collation_says_so(spark):
    chars = [chr(c) for c in range(0x20, 0x7F)]
    texts = chars + [a + b for a in "aZ -'_" for b in chars] + ["", "  ", "Ab c ", "aB C", "ab  c", "a-b", "ab"]
    df = spark.createDataFrame([(t,) for t in dict.fromkeys(texts)], "t string")
    assert is_plain(df, ["t"])
    both = collate(df).crossJoin(collate(df).withColumnRenamed("t", "u"))
    assert both.where((F.col("t") == F.col("u")) != (folded("t") == folded("u"))).isEmpty()
    for odd in ("ａbc", "a\x01", "ﬁn", "café", "a\tb"):
        assert not is_plain(df.union(spark.createDataFrame([(odd,)], "t string")), ["t"])
    assert not can_fold(df, ["t"])                                  # binary text
    assert not can_fold(collate(df, "UNICODE_CI"), ["t"])           # keeps trailing blanks
    assert can_fold(collate(spark.createDataFrame([(None,)], "t string")), ["t"])


def test_plain_keys_are_grouped_without_the_collator(spark):
    df = collate(spark.createDataFrame([("abc", 1), ("ABC ", 2), (None, 3), (None, 4)], "k string, n int"))
    assert plan(keep_first(df, ["k"], ["n"])).count("lower(rtrim(") and rows(keep_first(df, ["k"], ["n"])) == \
        [("abc", 1), (None, 3)]
    assert rows(group_by(df, ["k"], F.sum("n").alias("n"), fold=can_fold(df, ["k"]))) == [("ABC ", 3), (None, 7)]
    odd = df.union(collate(spark.createDataFrame([("ａbc", 0)], "k string, n int")))
    assert not can_fold(odd, ["k"]) and "lower(rtrim(" not in plan(keep_first(odd, ["k"], ["n"]))
    assert rows(keep_first(odd, ["k"], ["n"])) == [("ａbc", 0), (None, 3)]


@pytest.mark.parametrize("odd", [False, True])
def test_order_fact_joins_every_spelling(spark, stub, odd):
    def silver(table, *given):
        named = [{**dict.fromkeys(SILVER[table].fieldNames()), **g} for g in given]
        return collate(spark.createDataFrame([tuple(r.values()) for r in named], SILVER[table]))
    order = "ａ 1" if odd else "a 1"
    wh = stub(spark, {
        "sales_ord_details": silver("sales_ord_details", dict(order_id=order, customer_id="C1"),
                                    dict(order_id="b", customer_id=None), dict(order_id=None, customer_id="c1  ")),
        "sales_ord_items": silver("sales_ord_items", dict(order_id="A 1 "), dict(order_id="a 1"), dict(order_id=None)),
        "finance_ord_payments": silver("finance_ord_payments", dict(order_id="A 1"), dict(order_id="a 1  ")),
        "crm_cust_reviews": silver("crm_cust_reviews", dict(order_id="A 1", review_id="r")),
        "crm_cust_info": silver("crm_cust_info", dict(customer_id="c1", customer_unique_id="U")),
    })
    fact = gold.fact_sales(wh, keyed=False)
    assert rows(fact.select("order_id", "customer_unique_id", "total_items", "payment_count", "review_id")) == \
        sorted([(order, "U", 2, 2, "r"), ("b", None, 0, None, "n/a"), (None, "U", 0, None, "n/a")], key=repr)
    assert is_collated(fact.schema["order_id"].dataType)
    assert ("collationkey(order_id" in plan(fact)) == odd and "collationkey(customer_id" not in plan(fact)
