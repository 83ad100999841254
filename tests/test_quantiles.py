import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators import quantile_buckets

SCHEMA = "amount decimal(20,2), name string, id int, at timestamp, x double"


def _frame(spark, n, seed=1, hot=0.0):
    r = random.Random(seed)
    def row(i):
        amount = Decimal("7.50") if r.random() < hot else r.choice([None, Decimal(r.randint(-999, 999)) / 4])
        return (amount, r.choice([None, "", "a", "é", "zz"]), i,
                r.choice([None, dt.datetime(2021, 10, 31, r.randint(0, 5))]),
                r.choice([None, float("nan"), -0.0, 0.0, 1e300, float("-inf")]))
    return spark.createDataFrame([row(i) for i in range(n)], SCHEMA).repartition(5, "id")


def _window(order):
    return Window.orderBy(*[F.col(c).asc_nulls_first() if up else F.col(c).desc_nulls_last()
                            for c, up in order])


@pytest.mark.parametrize("n,buckets,small,order", [
    (1500, 10, 20, [("amount", False), ("name", True), ("id", True)]),
    (1500, 7, 5, [("x", True), ("at", False), ("id", False)]),
    (13, 4, 100_000, [("amount", True), ("id", True)]),
    (7, 10, 1, [("id", True)]),
    (40, 1, 5, [("id", True)]),
])
def test_equals_ntile(spark, n, buckets, small, order):
    df = _frame(spark, n, seed=n + buckets, hot=0.35)
    ours = quantile_buckets(df, order, buckets, "b", small=small)
    ref = df.withColumn("b", F.ntile(buckets).over(_window(order)))
    assert ours.columns == ref.columns
    assert sorted(map(tuple, ours.select("id", "b").collect())) == \
        sorted(map(tuple, ref.select("id", "b").collect()))


def test_equal_rows_share_the_earliest_bucket(spark):
    df = _frame(spark, 900, seed=5, hot=0.4)
    order = [("amount", True)]
    ours = quantile_buckets(df, order, 9, "b", small=4)
    ref = (df.withColumn("b", F.ntile(9).over(_window(order)))
           .withColumn("b", F.min("b").over(Window.partitionBy("amount"))))
    assert sorted(map(tuple, ours.select("id", "b").collect())) == \
        sorted(map(tuple, ref.select("id", "b").collect()))


def test_one_value_everywhere_and_no_rows(spark):
    one = spark.range(500).select(F.lit("same").alias("k"))
    assert {r["b"] for r in quantile_buckets(one, [("k", True)], 4, "b", small=3).collect()} == {1}
    none = _frame(spark, 1).where("id < 0")
    out = quantile_buckets(none, [("id", True)], 4, "b")
    assert out.count() == 0 and dict(out.dtypes)["b"] == "int"


def test_rows_are_neither_shuffled_nor_sorted(spark):
    out = quantile_buckets(_frame(spark, 200), [("amount", False), ("id", True)], 10, "b", small=10)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan and "Window" not in plan


def test_refused(spark):
    df = spark.range(3).select("id", F.array("id").alias("a"))
    with pytest.raises(ValueError):
        quantile_buckets(df, [("a", True)], 2, "b")
    with pytest.raises(ValueError):
        quantile_buckets(df, [("id", True)], 1000, "b")
