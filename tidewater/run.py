"""Run the whole warehouse on a folder of test tables:

    python -m tidewater.run --sf-dir /root/testdata/sf0.01 --out <shared folder>

export sources -> load_bronze -> load_silver -> build_gold -> every report of
the EDA, advanced-analytics and quality suites written as a parquet table
under ``<out>/reports``, then the load audit printed. ``--out`` must be a
folder every executor can reach (HDFS/S3/ABFS on a cluster).
"""

from __future__ import annotations

import argparse

from tidewater.plans import advanced, eda, quality
from tidewater.plans.warehouse import (LoadAudit, MaterializedLayer, Warehouse, build_gold,
                                       export_sources, load_bronze, load_silver, register_catalog)
from tidewater.session import build_session, clear_staging

REPORTS = {
    **{f"eda_{n}": getattr(eda, n) for n in (
        "total_orders", "total_customers", "total_products", "total_sellers", "repeat_customers",
        "customers_by_state", "top_customers", "customer_type_per_customer", "monthly_orders",
        "average_order_value", "orders_by_status", "avg_delivery_days",
        "avg_freight_and_order_value", "items_per_product", "popular_products",
        "revenue_per_product", "seller_performance", "payment_methods", "average_review_score")},
    **{f"advanced_{n}": getattr(advanced, n) for n in (
        "retention", "high_value_customers", "rfm", "monthly_revenue_growth",
        "revenue_concentration", "delivery_status", "delay_vs_review", "delivery_by_state",
        "installment_analysis")},
}


class _Layers(MaterializedLayer):
    """Bronze, silver and gold read from the folders the jobs wrote: the
    reports query the materialised gold models instead of rebuilding them."""

    def __init__(self, spark, bronze_root, silver_root, gold_root):
        super().__init__(spark, silver_root)
        self._bronze = MaterializedLayer(spark, bronze_root)
        self._gold = MaterializedLayer(spark, gold_root)

    def bronze(self, name):
        return self._bronze.bronze(name)

    def gold_table(self, name):
        return self._gold.silver(name)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)
    spark = build_session(master=args.master)
    out = args.out.rstrip("/")
    src, bronze, silver, gold_root = (f"{out}/{n}" for n in ("sources", "bronze", "silver", "gold"))
    audit = LoadAudit()
    export_sources(Warehouse(spark, args.sf_dir), src)
    load_bronze(spark, src, bronze, audit)
    load_silver(spark, bronze, silver, audit)
    build_gold(spark, silver, gold_root, audit)
    register_catalog(spark, bronze, silver, gold_root)   # bronze.*, silver.*, gold.*, gold_v2.*
    layers = _Layers(spark, bronze, silver, gold_root)
    for name, fn in REPORTS.items():
        audit.run("report", name, lambda fn=fn, name=name: _write(fn(layers), f"{out}/reports/{name}"))
    audit.run("report", "quality_suite",
              lambda: _write(quality.run_suite(layers), f"{out}/reports/quality_suite"))
    audit.to_df(spark).show(100, truncate=False)
    clear_staging(spark)
    spark.stop()


def _write(df, path):
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


if __name__ == "__main__":
    main()
