"""The whole warehouse as jobs: export -> bronze -> silver -> gold -> reports,
and the reports read from materialised gold equal the on-the-fly queries."""

import tempfile

from __spark_entry__ import queries
from tidewater.plans import advanced, eda
from tidewater.plans.registry import present
from tidewater.plans.warehouse import (LoadAudit, MaterializedLayer, Warehouse, build_gold,
                                       export_sources, load_bronze, load_silver, register_catalog)
from tidewater.sources import read_table

SF = "/root/testdata/sf0.001"


class Layers(MaterializedLayer):
    def __init__(self, spark, silver_root, gold_root):
        super().__init__(spark, silver_root)
        self.gold = MaterializedLayer(spark, gold_root)

    def gold_table(self, name):
        return self.gold.silver(name)


def rows(df):
    return sorted(map(tuple, present(df).collect()), key=str)


def test_pipeline_end_to_end(spark):
    root = tempfile.mkdtemp(prefix="tw-pipe-")
    src, bronze, silver, gold = (f"{root}/{n}" for n in ("src", "bronze", "silver", "gold"))
    audit = LoadAudit()
    export_sources(Warehouse(spark, SF), src)
    load_bronze(spark, src, bronze, audit, max_rejects=0)
    load_silver(spark, bronze, silver, audit)
    build_gold(spark, silver, gold, audit)
    report = {(r.layer, r.table_name): r for r in audit.to_df(spark).collect()}
    assert len(report) == 9 + 9 + 5 and all(r.status == "ok" for r in report.values())
    assert all(r.rejected == 0 for r in report.values() if r.layer == "bronze")

    layers = Layers(spark, silver, gold)
    q = queries()
    assert rows(advanced.delivery_status(layers)) == rows(q["v6_delivery_status"](spark, SF))
    assert rows(eda.top_customers(layers)) == rows(q["k7_top_customers"](spark, SF))
    # keys fixed at build time and consistent between dimension and item fact
    built = read_table(spark, f"{gold}/fact_sales_items").where("customer_key IS NOT NULL")
    dims = read_table(spark, f"{gold}/dim_customer")
    assert built.count() > 0
    n_keys = dims.selectExpr("concat('CUST', cast(customer_key AS string)) AS customer_key") \
        .join(built.select("customer_key").distinct(), "customer_key").count()
    assert n_keys == built.select("customer_key").distinct().count()

    # the source's own SQL names work once the layers are registered
    register_catalog(spark, bronze, silver, gold)
    assert spark.sql("SELECT COUNT(*) AS total_orders FROM gold.fact_sales").first()[0] == \
        q["k1_total_orders"](spark, SF).first()[0]
    assert spark.sql("SELECT COUNT(*) FROM gold_v2.fact_sales").first()[0] == \
        read_table(spark, f"{gold}/fact_sales_items").count()
    assert spark.sql("SELECT COUNT(*) FROM silver.crm_cust_reviews").first()[0] > 0
