"""Advanced analytics on gold v1 (V1-V9)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions import day_diff, exact_avg, int_avg, pct, round_avg
from tidewater.operators import group_by, percent_of_total, quantile_buckets
from tidewater.plans import gold
from tidewater.plans.eda import orders_per_customer

# The source starts the growth series here; the cut-off is a parameter.
DEFAULT_GROWTH_START = _dt.datetime(2017, 1, 1)


def _customer_type():
    return F.when(F.col("total_orders") == 1, "One-Time Customer").otherwise("Repeat Customer")


def retention(wh) -> DataFrame:
    """V1: one-time vs repeat customers and their share. The inner aggregate
    is per customer; the outer one has two rows, so the share's empty window
    is over two rows."""
    by_type = orders_per_customer(wh).groupBy(_customer_type().alias("customer_type")) \
        .agg(F.count(F.lit(1)).alias("total_customers"))
    out = percent_of_total(by_type, "total_customers", "customer_percentage")
    return out.select("customer_type", "total_customers",
                      "customer_percentage") \
        .orderBy(F.desc("total_customers"), "customer_type")


def high_value_customers(wh, n: int = 10) -> DataFrame:
    """V2: top spenders by COUNT(order_id) and SUM(total_price)."""
    return (orders_per_customer(wh)
            .orderBy(F.desc("total_spent"), F.asc_nulls_first("customer_unique_id")).limit(n)
            .select("customer_unique_id", F.col("order_ids").alias("total_orders"),
                    "total_spent"))


def rfm(wh) -> DataFrame:
    """V3: recency (days from the customer's last purchase to the latest
    purchase overall), frequency, monetary. The overall latest purchase is a
    scalar subquery: one extra partial/final max, no join, nothing on the driver."""
    f = gold.fact_sales(wh, keyed=False)
    latest = f.select(F.max("order_purchase_timestamp")).scalar()
    per = group_by(
        f, ["customer_unique_id"],
        F.max("order_purchase_timestamp").alias("_last"),
        F.count("order_id").alias("frequency"),
        F.sum("total_price").alias("monetary"))
    return per.select("customer_unique_id", day_diff(F.col("_last"), latest).alias("recency"),
                      "frequency", "monetary")


def monthly_revenue_growth(wh, start: _dt.datetime = DEFAULT_GROWTH_START) -> DataFrame:
    """V4: revenue per month from ``start`` and growth against the previous
    available month (L25). The window runs over the monthly aggregate, whose
    size is the number of months, not the number of orders."""
    ts = F.col("order_purchase_timestamp")
    monthly = gold.fact_sales(wh, keyed=False).where(ts >= F.lit(start).cast("timestamp_ntz")) \
        .groupBy(F.year(ts).alias("order_year"), F.month(ts).alias("order_month")) \
        .agg(F.sum("total_price").alias("monthly_revenue"))
    w = Window.orderBy("order_year", "order_month")
    prev = F.lag("monthly_revenue").over(w)
    out = monthly.withColumn("previous_month_revenue", prev)
    growth = pct(F.col("monthly_revenue") - F.col("previous_month_revenue"),
                 F.col("previous_month_revenue"))
    return out.select("order_year", "order_month",
                      "monthly_revenue",
                      "previous_month_revenue",
                      growth.alias("mom_growth_percentage")) \
        .orderBy("order_year", "order_month")


def customer_deciles(wh, buckets: int = 10) -> DataFrame:
    """E8 as used by V5: NTILE over customers by spend, highest first, ties by id."""
    per = gold.fact_sales(wh, keyed=False).groupBy("customer_unique_id") \
        .agg(F.sum("total_price").alias("total_spent"))
    return quantile_buckets(per, [("total_spent", False), ("customer_unique_id", True)],
                            buckets, "revenue_decile")


def revenue_concentration(wh) -> DataFrame:
    """V5: share of revenue from the top decile of customers."""
    d = customer_deciles(wh)
    top = F.sum(F.when(F.col("revenue_decile") == 1, F.col("total_spent")).otherwise(F.lit(0)))
    return d.agg(pct(top, F.sum("total_spent")).alias("top_10_percent_revenue_share"))


def delivery_status(wh) -> DataFrame:
    """V6: Late means delivered after midnight of the estimated date."""
    f = gold.fact_sales(wh, keyed=False)
    delivered, estimate = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    status = F.when(delivered.isNull(), "Not Delivered") \
              .when(delivered > estimate.cast("timestamp_ntz"), "Late").otherwise("On Time")
    by = f.groupBy(status.alias("delivery_status")).agg(F.count(F.lit(1)).alias("total_orders"))
    out = percent_of_total(by, "total_orders", "order_percentage")
    return out.select("delivery_status", "total_orders",
                      "order_percentage") \
        .orderBy(F.desc("total_orders"), "delivery_status")


def delay_vs_review(wh) -> DataFrame:
    """V7: whole days late (a delivery on the estimated day is on time here,
    unlike V6) against the integer average review score of reviewed orders."""
    f = gold.fact_sales(wh, keyed=False).where(
        F.col("order_delivered_customer_date").isNotNull()
        & F.col("order_estimated_delivery_date").isNotNull() & (F.col("review_score") > 0))
    d = day_diff("order_estimated_delivery_date", "order_delivered_customer_date")
    cat = (F.when(d < 0, "Delivered Early").when(d == 0, "Delivered On Time")
            .when(d.between(1, 3), "1-3 Days Late").when(d.between(4, 7), "4-7 Days Late")
            .otherwise("More Than 7 Days Late"))
    return f.groupBy(cat.alias("delivery_category")).agg(
        F.count(F.lit(1)).alias("total_orders"), int_avg("review_score").alias("avg_review_score"),
        exact_avg("review_score").alias("avg_review_score_exact")) \
        .orderBy(F.desc("avg_review_score"), "delivery_category")


def delivery_by_state(wh) -> DataFrame:
    """V8: delivered orders, late orders and average days per customer state.

    Facts are first reduced to one row per customer (sums and counts are
    additive), then mapped to a state through the one-row-per-customer
    dimension, then summed per state. The join thus sees one row per customer
    instead of one per order, and the unmatched-customer group is one row."""
    f = gold.fact_sales(wh, keyed=False).where(
        F.col("order_delivered_customer_date").isNotNull()
        & F.col("order_estimated_delivery_date").isNotNull())
    late = (F.col("order_delivered_customer_date")
            > F.col("order_estimated_delivery_date").cast("timestamp_ntz"))
    days = day_diff("order_purchase_timestamp", "order_delivered_customer_date")
    per_customer = f.groupBy("customer_unique_id").agg(
        F.count("order_id").alias("n"), F.sum(F.when(late, 1).otherwise(0)).alias("late"),
        F.sum(days).alias("days"), F.count(days).alias("n_days"))
    dc = gold.dim_customer(wh, keyed=False).select("customer_unique_id", "customer_state")
    per_state = per_customer.join(dc, "customer_unique_id", "left").groupBy("customer_state").agg(
        F.sum("n").alias("delivered_orders"), F.sum("late").alias("late_orders"),
        F.sum("days").alias("days"), F.sum("n_days").alias("n_days"))
    avg_days = F.round(F.col("days").cast("decimal(38,6)") / F.nullif(F.col("n_days"), F.lit(0)), 2)
    return per_state.select(
        "customer_state", "delivered_orders", "late_orders",
        pct(F.col("late_orders"), F.col("delivered_orders")).alias("late_delivery_percentage"),
        avg_days.alias("avg_delivery_days")) \
        .orderBy(F.desc("late_delivery_percentage"), "customer_state")


def installment_analysis(wh) -> DataFrame:
    """V9: 'Installment' when the summed installments exceed 1."""
    f = gold.fact_sales(wh, keyed=False)
    cat = F.when(F.col("total_payment_installments") > 1, "Installment Payment") \
           .otherwise("Single Payment")
    return f.groupBy(cat.alias("payment_category")).agg(
        F.count(F.lit(1)).alias("total_orders"),
        round_avg("total_price").alias("average_order_value"),
        round_avg("total_payment_value").alias("average_payment_value")) \
        .orderBy(F.desc("average_order_value"), "payment_category")
