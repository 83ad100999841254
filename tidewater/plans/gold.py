"""Gold star schemas.

v1 (order grain): ``dim_customer``, ``dim_seller``, ``dim_products`` and
``fact_sales`` with one row per order, child tables aggregated to order level
before joining so items and payments do not multiply each other.
v2 (order-item grain): same dimensions, ``fact_sales_items`` with one row per
order item and text keys built from natural ids.

Surrogate keys (``*_key``) are dense 1..N in key order, computed with the
distributed row number; pass ``keyed=False`` when a consumer does not need
them (the analytics do not), which saves the staging write. On a layer with key
maps (``build_gold``) members keep the keys of the loads before and new ones
get the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import can_fold, folded, prefixed_key
from tidewater.operators import (extend_key_map, global_row_number, hot_keys, keep_first,
                                 left_join_salted, left_join_spread_null_keys, with_keys)
from tidewater.session import drop_staged, staged, staging_path
from tidewater.sources.snapshots import Buckets, SnapshotTable


def _keyed(wh, df: DataFrame, model: str, key: str, natural, keyed: bool) -> DataFrame:
    if not keyed:
        return df
    maps = getattr(wh, "key_map", None)
    if maps is None:
        return global_row_number(df, list(natural), key)
    # once for the members and once for the rows: written, not derived twice
    df = staged(df, staging_path(df.sparkSession, model))
    return with_keys(df, extend_key_map(maps(model), df, natural, key), natural, key)


def _built(wh, model: str, key: str, keyed: bool) -> DataFrame | None:
    """The materialised model when the layer has one (``build_gold`` output
    behind ``wh.gold_table``): query it instead of rebuilding it, with the
    keys fixed at build time (ledger L12)."""
    reader = getattr(wh, "gold_table", None)
    df = reader(model) if reader is not None else None
    if df is None:
        return None
    return df if keyed else df.drop(key)


def dim_customer(wh, keyed: bool = True) -> DataFrame:
    """One row per customer_unique_id, the highest customer_id kept."""
    built = _built(wh, "dim_customer", "customer_key", keyed)
    if built is not None:
        return built
    c = wh.silver("crm_cust_info")
    latest = keep_first(c, ["customer_unique_id"], ["customer_id"], descending=True)
    d = latest.select("customer_unique_id", "customer_zip_code", "customer_city", "customer_state")
    return _keyed(wh, d, "dim_customer", "customer_key", ["customer_unique_id"], keyed)


def first_geolocation(wh) -> DataFrame:
    """One coordinate per zip prefix: the lowest (lat, lng) as text."""
    g = wh.silver("reference_geolocation")
    first = keep_first(g, ["geolocation_zip_code_prefix"],
                       ["geolocation_lat", "geolocation_lng", "geolocation_city",
                        "geolocation_state"])
    return first.select("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng")


def dim_seller(wh, keyed: bool = True) -> DataFrame:
    """Sellers with the first coordinate of their zip prefix."""
    built = _built(wh, "dim_seller", "seller_key", keyed)
    if built is not None:
        return built
    s = wh.silver("prd_seller_details")
    g = first_geolocation(wh)      # one row per zip prefix
    d = s.join(g, s.seller_zip_code_prefix == g.geolocation_zip_code_prefix, "left") \
         .select("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state",
                 "geolocation_lat", "geolocation_lng")
    return _keyed(wh, d, "dim_seller", "seller_key", ["seller_id"], keyed)


def dim_products(wh, keyed: bool = True) -> DataFrame:
    """Products with the English category name, 'n/a' when untranslated.
    A category translated twice gets the first translation in text order, so
    the dimension keeps one row per product."""
    built = _built(wh, "dim_products", "product_key", keyed)
    if built is not None:
        return built
    p = wh.silver("prd_item_details")
    t = wh.silver("prd_translations") \
        .groupBy(F.col("product_category_name").alias("_tw_cat")) \
        .agg(F.min("product_category_name_english").alias("product_category_name_english"))
    d = p.join(t, p.product_category_name == t._tw_cat, "left").select(
                 "product_id",
                 F.coalesce("product_category_name_english", F.lit("n/a")).alias("product_category_name"),
                 "product_photos_qty", "product_weight_g", "product_length_cm",
                 "product_height_cm", "product_width_cm")
    return _keyed(wh, d, "dim_products", "product_key", ["product_id"], keyed)


def _keys_fold(wh, column: str, *tables: str) -> bool:
    """Whether a key is collated and plain text in all ``tables``, so that they are joined
    and grouped by its folded text, without the collator. Bronze has the same texts
    or, before cleaning, more characters, and needn't be deduplicated for this."""
    return all(can_fold(wh.silver(tables[0]), [column], wh.bronze(t)) for t in tables)


def _by_fold(df: DataFrame, column: str, fold: bool) -> DataFrame:
    return df.withColumn(column, folded(column)) if fold else df


def order_item_totals(wh, fold: bool = False) -> DataFrame:
    """Items per order (C3): earliest shipping limit, count, price and freight."""
    return _by_fold(wh.silver("sales_ord_items"), "order_id", fold).groupBy("order_id").agg(
        F.min("shipping_limit_date").alias("shipping_limit_date"),
        F.count(F.lit(1)).alias("total_items"),
        F.sum("price").alias("total_price"),
        F.sum("freight_value").alias("total_freight_value"))


def order_payment_totals(wh, fold: bool = False) -> DataFrame:
    """Payments per order."""
    return _by_fold(wh.silver("finance_ord_payments"), "order_id", fold).groupBy("order_id").agg(
        F.count(F.lit(1)).alias("payment_count"),
        F.sum("payment_installments").cast("long").alias("total_payment_installments"),
        F.sum("payment_value").alias("total_payment_value"))


def fact_sales(wh, keyed: bool = True) -> DataFrame:
    """One row per order. All children are keyed on order_id, so the
    aggregates come out hash-partitioned on it and the order-side joins reuse
    that partitioning; only the customer mapping needs another shuffle."""
    built = _built(wh, "fact_sales", "order_key", keyed)
    if built is not None:
        return built
    od = wh.silver("sales_ord_details")
    rv = wh.silver("crm_cust_reviews").select("order_id", "review_id", "review_score",
                                              "review_creation_date", "review_answer_date")
    ci = wh.silver("crm_cust_info").select("customer_id", "customer_unique_id")
    order = _keys_fold(wh, "order_id", "sales_ord_details", "sales_ord_items", "finance_ord_payments",
                       "crm_cust_reviews")
    customer = _keys_fold(wh, "customer_id", "sales_ord_details", "crm_cust_info")
    if order:       # shown as the order spells it
        od = od.withColumn("_tw_order_id", F.col("order_id"))
    j = (_by_fold(_by_fold(od, "order_id", order), "customer_id", customer)
         .join(order_item_totals(wh, order), "order_id", "left")
         .join(order_payment_totals(wh, order), "order_id", "left")
         .join(_by_fold(rv, "order_id", order), "order_id", "left"))
    j = left_join_spread_null_keys(j, _by_fold(ci, "customer_id", customer), "customer_id", salt_from="order_id")
    f = j.select(
        F.col("_tw_order_id" if order else "order_id").alias("order_id"), "customer_unique_id", "order_status", "order_purchase_timestamp",
        "order_approved_at", "shipping_limit_date", "order_delivered_carrier_date",
        "order_delivered_customer_date", "order_estimated_delivery_date",
        F.coalesce("total_items", F.lit(0)).alias("total_items"),
        F.coalesce("total_price", F.lit(0)).alias("total_price"),
        F.coalesce("total_freight_value", F.lit(0)).alias("total_freight_value"),
        "payment_count", "total_payment_installments", "total_payment_value",
        F.coalesce("review_id", F.lit("n/a")).alias("review_id"),
        F.coalesce("review_score", F.lit(0)).alias("review_score"),
        "review_creation_date", "review_answer_date")
    return _keyed(wh, f, "fact_sales", "order_key", ["order_id"], keyed)


def _dimension_keys(wh, model: str, key: str, members: DataFrame) -> DataFrame:
    """(natural key, surrogate key) of a dimension, the numbers that the dimension has:
    its other columns are neither joined, nor numbered with it. ``members`` has one
    row for each of the dimension's, its natural key alone."""
    natural = members.columns[0]
    built = _built(wh, model, key, True)
    if built is not None:
        return built.select(natural, key)
    return _keyed(wh, members, model, key, [natural], True).select(natural, key)


ITEM_ORDER = ("order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date",
              "price", "freight_value")


def _items_once(wh) -> tuple[DataFrame, str | None]:
    """Silver items as a written table, and its folder if it was staged for this. They
    are read twice (hot keys, the first join): a layer that derives them would
    deduplicate all items each time."""
    oi = wh.silver("sales_ord_items")
    if getattr(wh, "materialized", False):
        return oi, None
    path = staging_path(oi.sparkSession, "items")
    return staged(oi, path), path


def _sold_items(items: DataFrame, own: str | None, members, hot: dict[str, DataFrame],
                dealt: Buckets | None) -> tuple[DataFrame, Callable[[], None]]:
    """``items`` with the keys of their ``members``, (column, dimension) each, as a written
    table, and what removes it. All items are shuffled for each dimension, and to be
    dealt again; each time the result is written, and the shuffle and the table before
    are removed, so one shuffle of the items is on the disks at a time, not all. ``own``
    is the folder of ``items`` if it was staged for this."""
    spark = items.sparkSession

    def used(path: str | None) -> None:
        if path:
            drop_staged(spark, path)

    for column, dimension in members:
        path = staging_path(spark, f"items-{column}")
        j = left_join_salted(items, dimension, column, hot[column], salt_from="order_id")
        added = [c for c in dimension.columns if c != column]
        items = staged(j.select(*items.columns, *added), path)
        used(own)
        own = path
    if dealt is None:
        return items, lambda: used(own)
    table = SnapshotTable(spark, staging_path(spark, "items-dealt"))
    items = table.replace(items, buckets=dealt)
    used(own)
    return items, table.remove


def fact_sales_items(wh, keyed: bool = True) -> DataFrame:
    """One row per order item with text keys ``CUST<customer_key>``,
    ``PRD<product_id>``, ``S<seller_id>`` (whole values, null when the dimension
    has no match), and the dimensions' own keys as ``customer_sk``, ``product_sk``
    and ``seller_sk`` (ledger L7). Payments and reviews stay out of this grain."""
    built = _built(wh, "fact_sales_items", "sales_key", keyed)
    if built is not None:
        return built
    oi, own = _items_once(wh)
    od = wh.silver("sales_ord_details").select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp",
        "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
        "order_estimated_delivery_date")
    ci = wh.silver("crm_cust_info").select("customer_id", "customer_unique_id")
    dc = _dimension_keys(wh, "dim_customer", "customer_key", ci.select("customer_unique_id").distinct())
    dp = _dimension_keys(wh, "dim_products", "product_key",
                         wh.silver("prd_item_details").select("product_id")) \
        .withColumnRenamed("product_key", "product_sk")
    ds = _dimension_keys(wh, "dim_seller", "seller_key",
                         wh.silver("prd_seller_details").select("seller_id")) \
        .withColumnRenamed("seller_key", "seller_sk")
    # The customer mapping is done at order grain, then joined to the items
    # once. Same result as chaining every join at item grain (each join's
    # condition uses only the table before it, so the left joins associate),
    # but the customer joins see one row per order, and a customer with a
    # huge share of the items is no longer a hot key at item grain; one with a
    # huge share of the orders is salted like the item keys below. The keys are
    # joined to the customer ids first, which have two columns; the orders with
    # all of theirs are shuffled for one join only.
    frequent = hot_keys(ci, ["customer_unique_id"])["customer_unique_id"]
    customers = left_join_salted(ci, dc, "customer_unique_id", frequent, salt_from="customer_id") \
        .select("customer_id", "customer_key")
    orders = left_join_spread_null_keys(od, customers, "customer_id", salt_from="order_id") \
        .drop("customer_id")
    # An order, product or seller holding a large share of all items is
    # spread over many reducers; the hot values of all three keys are found
    # in one pass over the items. They meet products and sellers before they
    # have the columns of their orders. Bucketed items have no hot order; they are
    # dealt again then, and only the order side is shuffled to meet them.
    dealt = getattr(wh, "buckets", lambda name: None)("sales_ord_items")
    bucketed = dealt is not None and dealt.column == "order_id"
    hot = hot_keys(oi, ["product_id", "seller_id"] if bucketed else ["order_id", "product_id", "seller_id"])
    sold, remove = _sold_items(oi.select(*ITEM_ORDER), own, (("product_id", dp), ("seller_id", ds)), hot,
                               dealt if bucketed else None)
    if bucketed:
        j = sold.join(orders, "order_id", "left")
    else:
        j = left_join_salted(sold, orders, "order_id", hot["order_id"], salt_from="order_item_id")
    # numbered without the text keys, which are made of other columns
    f = _keyed(wh, j.select(*ITEM_ORDER, "customer_key", "product_sk", "seller_sk", "order_status",
                            "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
                            "order_delivered_customer_date", "order_estimated_delivery_date"),
               "fact_sales_items", "sales_key", ITEM_ORDER, keyed)
    if keyed:       # the rows are written
        remove()
    return f.select(
        *(["sales_key"] if keyed else []), "order_id", "order_item_id",
        prefixed_key("CUST", F.col("customer_key")).alias("customer_key"),
        prefixed_key("PRD", F.when(F.col("product_sk").isNotNull(), F.col("product_id")))
        .alias("product_key"),
        prefixed_key("S", F.when(F.col("seller_sk").isNotNull(), F.col("seller_id"))).alias("seller_key"),
        "order_status", "order_purchase_timestamp", "order_approved_at", "shipping_limit_date",
        "order_delivered_carrier_date", "order_delivered_customer_date",
        "order_estimated_delivery_date", "price", "freight_value",
        F.col("customer_key").alias("customer_sk"), "product_sk", "seller_sk")
