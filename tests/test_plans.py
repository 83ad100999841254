"""Scale properties of the physical plans, pinned as tests (see PLANS.md)."""

import re

import pytest

from tidewater.plans import advanced, eda, gold
from tidewater.plans.warehouse import Warehouse

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


@pytest.fixture
def wh(spark):
    return Warehouse(spark, SF)


def test_dedupe_is_a_partial_aggregate_not_a_window(wh):
    for table, partial in (("crm_cust_reviews", "partial_max"), ("sales_ord_items", "partial_min")):
        p = plan(wh.silver(table))
        assert partial in p and "Window" not in p


def test_order_fact_salts_the_customer_join(wh):
    p = plan(gold.fact_sales(wh, keyed=False))
    assert "[customer_id, _tw_salt]" in p


def test_unused_fact_joins_are_pruned_and_columns_too(wh):
    p = plan(eda.total_orders(wh))
    assert "lineitem.parquet" not in p            # item totals not needed for a count
    assert "o_totalprice" not in p                # payments not needed either


def test_top_k_is_take_ordered(wh):
    assert "TakeOrderedAndProject" in plan(eda.top_customers(wh))


def test_rfm_global_max_is_a_scalar_subquery(wh):
    p = plan(advanced.rfm(wh))
    assert "Subquery" in p and "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_v8_joins_the_dimension_after_reducing_per_customer(wh):
    p = plan(advanced.delivery_by_state(wh))
    # the per-customer aggregate sits below the join with the dimension
    join_at = p.index("Join")
    assert "HashAggregate(keys=[customer_unique_id" in p[join_at:]


def test_row_number_gathers_only_partition_counts(spark):
    from pyspark.sql import functions as F

    from tidewater.operators import global_row_number
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).alias("k"))
    p = plan(global_row_number(df, ["k"], "rn", num_partitions=6))
    assert p.count("Exchange SinglePartition") == 1
    single = p[p.index("Exchange SinglePartition"):]
    assert "functions=[partial_count(1)]" in single and "BroadcastHashJoin" in p


def test_counts_of_dimensions_start_no_job_before_the_action(spark, wh):
    sc = spark.sparkContext
    sc.setJobGroup("lazy-dimensions", "")
    try:
        eda.total_products(wh), eda.total_sellers(wh)
        assert not list(sc.statusTracker().getJobIdsForGroup("lazy-dimensions"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_item_fact_derives_the_items_once(wh):
    p = plan(gold.fact_sales_items(wh, keyed=False))
    assert "lineitem.parquet" not in p and "items-" in p
