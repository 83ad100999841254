"""EDA reports on gold v1 (K1-K19). Each function returns a DataFrame.

Money columns are exact decimals. Integer averages truncate, as in the source,
with an ``*_exact`` twin beside them (ledger L2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import day_diff, exact_avg, int_avg, round_avg
from tidewater.operators import group_by
from tidewater.plans import gold


def _money(c, name: str):
    return (F.col(c) if isinstance(c, str) else c).alias(name)


def _count(name: str):
    return F.count(F.lit(1)).alias(name)


def total_orders(wh) -> DataFrame:
    """K1"""
    return gold.fact_sales(wh, keyed=False).agg(_count("total_orders"))


def total_customers(wh) -> DataFrame:
    """K2"""
    return gold.dim_customer(wh, keyed=False).agg(_count("total_customers"))


def total_products(wh) -> DataFrame:
    """K3"""
    return gold.dim_products(wh, keyed=False).agg(_count("total_products"))


def total_sellers(wh) -> DataFrame:
    """K4"""
    return gold.dim_seller(wh, keyed=False).agg(_count("total_sellers"))


def orders_per_customer(wh) -> DataFrame:
    """Orders and spend per customer_unique_id (the null group included, L23)."""
    return group_by(gold.fact_sales(wh, keyed=False), ["customer_unique_id"],
        _count("total_orders"), F.count("order_id").alias("order_ids"),
        F.sum("total_price").alias("total_spent"))


def repeat_customers(wh) -> DataFrame:
    """K5: customers with more than one order."""
    return orders_per_customer(wh).where(F.col("total_orders") > 1).agg(_count("repeat_customers"))


def customers_by_state(wh) -> DataFrame:
    """K6"""
    return group_by(gold.dim_customer(wh, keyed=False), ["customer_state"], _count("total_customers")) \
        .orderBy(F.desc("total_customers"), "customer_state")


def top_customers(wh, n: int = 10) -> DataFrame:
    """K7: top spenders; ties broken by id (L10). A top-k, planned as
    TakeOrderedAndProject (per-partition top n, then merge)."""
    return (orders_per_customer(wh)
            .orderBy(F.desc("total_spent"), F.asc_nulls_first("customer_unique_id")).limit(n)
            .select("customer_unique_id", "total_orders", _money("total_spent", "total_spent")))


def customer_type_per_customer(wh) -> DataFrame:
    """K8: one row per customer (the query groups by customer, L14)."""
    return orders_per_customer(wh).select(
        F.when(F.col("total_orders") == 1, "One-Time Customer").otherwise("Repeat Customer")
         .alias("customer_type"),
        F.col("total_orders").alias("customers"))


def monthly_orders(wh) -> DataFrame:
    """K9"""
    ts = F.col("order_purchase_timestamp")
    return gold.fact_sales(wh, keyed=False).groupBy(
        F.year(ts).alias("order_year"), F.month(ts).alias("order_month")) \
        .agg(_count("total_orders")).orderBy("order_year", "order_month")


def average_order_value(wh) -> DataFrame:
    """K10"""
    return gold.fact_sales(wh, keyed=False).agg(
        _money(round_avg("total_price"), "average_order_value"))


def orders_by_status(wh) -> DataFrame:
    """K11"""
    return group_by(gold.fact_sales(wh, keyed=False), ["order_status"], _count("total_orders")) \
        .orderBy(F.desc("total_orders"), "order_status")


def avg_delivery_days(wh) -> DataFrame:
    """Integer average of whole days from purchase to delivery."""
    f = gold.fact_sales(wh, keyed=False).where(F.col("order_delivered_customer_date").isNotNull())
    d = day_diff("order_purchase_timestamp", "order_delivered_customer_date")
    return f.agg(int_avg(d).alias("avg_delivery_days"), exact_avg(d).alias("avg_delivery_days_exact"))


def avg_freight_and_order_value(wh) -> DataFrame:
    """K13"""
    return gold.fact_sales(wh, keyed=False).agg(
        _money(round_avg("total_freight_value"), "avg_freight"),
        _money(round_avg("total_price"), "avg_order_value"))


def items_per_product(wh) -> DataFrame:
    """K14. As in the other reports, a second sort key makes the order total,
    so a range sort can split rows that tie on the first."""
    return group_by(wh.silver("sales_ord_items"), ["product_id"], _count("items_sold")) \
        .orderBy(F.desc("items_sold"), "product_id")


def _per_product_with_category(wh, measure) -> DataFrame:
    """Aggregate items per product first, then attach the category (C6): the
    aggregate is keyed on product_id, so the join reuses its partitioning."""
    per_product = wh.silver("sales_ord_items").groupBy("product_id").agg(measure)
    dp = gold.dim_products(wh, keyed=False).select("product_id", "product_category_name")
    return dp.join(per_product, "product_id", "right")


def popular_products(wh) -> DataFrame:
    """K15"""
    return _per_product_with_category(wh, _count("total_items")) \
        .orderBy(F.desc("total_items"), "product_id") \
        .select("product_category_name", "total_items")


def revenue_per_product(wh) -> DataFrame:
    """K16"""
    return _per_product_with_category(wh, F.sum("price").alias("total_revenue")) \
        .orderBy(F.desc("total_revenue"), "product_id") \
        .select("product_category_name", _money("total_revenue", "total_revenue"))


def seller_performance(wh) -> DataFrame:
    """K17"""
    return group_by(wh.silver("sales_ord_items"), ["seller_id"],
        _count("items_sold"), F.sum("price").alias("total_revenue")) \
        .select("seller_id", "items_sold", _money("total_revenue", "total_revenue")) \
        .orderBy(F.desc("items_sold"), "seller_id")


def payment_methods(wh) -> DataFrame:
    """K18"""
    return group_by(wh.silver("finance_ord_payments"), ["payment_type"], _count("payment_count")) \
        .orderBy(F.desc("payment_count"), "payment_type")


def average_review_score(wh) -> DataFrame:
    """Integer average; orders without review count as 0."""
    return gold.fact_sales(wh, keyed=False).agg(
        int_avg("review_score").alias("average_review_score"),
        exact_avg("review_score").alias("average_review_score_exact"))
