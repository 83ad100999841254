import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators import (drop_exact_duplicates, global_ntile, global_row_number,
                                 keep_first, keep_first_window, ntile_from_rank)


def rows(df, order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_keep_first_matches_window_desc(spark):
    data = [("o1", "2018-01-02", "r1", 5), ("o1", "2018-01-03", "r2", 3), ("o1", None, "r3", 1),
            ("o2", "2018-01-01", "r4", 2), ("o2", "2018-01-01", "r5", 4), (None, "2018-01-01", "r6", 1)]
    df = spark.createDataFrame(data, "k string, d string, id string, score int")
    fast = keep_first(df, ["k"], ["d", "id"], descending=True)
    ref = keep_first_window(df, ["k"], [F.col("d").desc_nulls_last(), F.col("id").desc_nulls_last()])
    assert rows(fast, ["k"]) == rows(ref, ["k"])
    assert fast.columns == df.columns


def test_keep_first_asc_nulls_first(spark):
    df = spark.createDataFrame([("z", None, 1), ("z", "a", 2)], "k string, lat string, n int")
    assert keep_first(df, ["k"], ["lat"]).first()["n"] == 1


def test_keep_first_single_order_column(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2)], "k string, item int")
    assert rows(keep_first(df, ["k"], ["item"]), ["k"]) == [("a", 1), ("b", 2)]


def test_drop_exact_duplicates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2)], "k string, v int")
    assert drop_exact_duplicates(df).count() == 2


def _random_frame(spark, n, seed=7):
    rnd = random.Random(seed)
    data = [(rnd.choice(["a", "b", "c", None]), rnd.randint(-50, 50), i) for i in range(n)]
    return spark.createDataFrame(data, "g string, v int, id int")


def test_global_row_number_equals_window(spark):
    df = _random_frame(spark, 2003)
    order = [F.col("v").desc(), F.col("g").asc_nulls_first(), F.col("id")]
    ours = global_row_number(df, order, "rn", num_partitions=7)
    ref = df.withColumn("rn", F.row_number().over(Window.orderBy(*order)))
    assert sorted(map(tuple, ours.select("id", "rn").collect())) == \
        sorted(map(tuple, ref.select("id", "rn").collect()))
    assert sorted(r[0] for r in ours.select("rn").collect()) == list(range(1, 2004))


def test_global_row_number_without_staging_input(spark):
    df = _random_frame(spark, 300, seed=3)
    ours = global_row_number(df, ["id"], "rn", num_partitions=4, stage_input=False)
    assert all(r["rn"] == r["id"] + 1 for r in ours.collect())


def test_global_ntile_equals_window(spark):
    for n, buckets in ((1001, 10), (7, 10), (40, 10), (13, 4)):
        df = _random_frame(spark, n, seed=n)
        order = [F.col("v").desc(), F.col("id")]
        ours = global_ntile(df, order, buckets, "b", num_partitions=5)
        ref = df.withColumn("b", F.ntile(buckets).over(Window.orderBy(*order)))
        assert sorted(map(tuple, ours.select("id", "b").collect())) == \
            sorted(map(tuple, ref.select("id", "b").collect()))


def test_ntile_bucket_sizes_differ_by_at_most_one(spark):
    df = spark.range(1, 1024).select(F.col("id").alias("rank"))
    b = df.select(ntile_from_rank(F.col("rank"), F.lit(1023), 10).alias("b")) \
        .groupBy("b").count().collect()
    sizes = sorted(r["count"] for r in b)
    assert len(sizes) == 10 and sizes[-1] - sizes[0] <= 1


def test_salted_left_join_equals_plain_left_join(spark):
    from tidewater.operators import left_join_spread_null_keys
    left = spark.createDataFrame([(i, None if i % 3 else f"k{i % 5}") for i in range(300)],
                                 "id int, k string")
    right = spark.createDataFrame([(f"k{i}", i) for i in range(4)] + [(None, 99)], "k string, v int")
    ours = left_join_spread_null_keys(left, right, "k", buckets=16)
    plain = left.join(right, "k", "left")
    assert sorted(map(tuple, ours.select("id", "k", "v").collect()), key=str) == \
        sorted(map(tuple, plain.select("id", "k", "v").collect()), key=str)
    plan = ours._jdf.queryExecution().executedPlan().toString()
    assert "_tw_salt" in plan.split("Join")[1].split("\n")[0]   # salt is a join key


def test_row_number_and_ntile_property(spark):
    from hypothesis import given, settings, strategies as st

    @settings(max_examples=8, deadline=None)
    @given(st.lists(st.tuples(st.integers(-5, 5), st.one_of(st.none(), st.sampled_from("abc"))),
                    min_size=0, max_size=60),
           st.integers(1, 6), st.integers(1, 12))
    def check(rows, parts, buckets):
        df = spark.createDataFrame([(v, g, i) for i, (v, g) in enumerate(rows)],
                                   "v int, g string, id int")
        order = [F.col("v").desc(), F.col("g").asc_nulls_first(), F.col("id")]
        ours = global_ntile(global_row_number(df, order, "rn", num_partitions=parts,
                                              stage_input=False),
                            order, buckets, "b", num_partitions=parts)
        w = Window.orderBy(*order)
        ref = df.withColumn("rn", F.row_number().over(w)).withColumn("b", F.ntile(buckets).over(w))
        assert sorted(map(tuple, ours.select("id", "rn", "b").collect())) == \
            sorted(map(tuple, ref.select("id", "rn", "b").collect()))

    check()


def test_split_hot_keys_join_equals_plain_left_join(spark):
    from tidewater.operators import left_join_split_hot_keys
    rows = [(i, "hot" if i % 3 else f"k{i % 7}") for i in range(3000)] + [(5000 + i, None) for i in range(50)]
    left = spark.createDataFrame(rows, "id int, k string")
    right = spark.createDataFrame([("hot", 1), ("k0", 2), ("k3", 3), ("k3", 4)], "k string, v int")
    ours = left_join_split_hot_keys(left, right, "k", salt_from="id", salts=8, min_hot_rows=10,
                                    partitions=16)
    plain = left.join(right, "k", "left")
    assert ours.count() == plain.count()
    assert sorted(map(tuple, ours.select("id", "k", "v").collect()), key=str) == \
        sorted(map(tuple, plain.select("id", "k", "v").collect()), key=str)
    salted = left_join_split_hot_keys(left, right, "k", salt_from="id", salts=8, min_hot_rows=10,
                                      partitions=16)
    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert "_tw_salt" in plan


def test_hot_keys_one_pass(spark):
    from tidewater.operators import hot_keys
    rows = [(i % 2 and "A" or f"o{i}", "P" if i % 3 else f"p{i}") for i in range(600)]
    df = spark.createDataFrame(rows, "o string, p string")
    hot = hot_keys(df, ["o", "p"], partitions=16, min_hot_rows=10)
    assert [r.o for r in hot["o"].collect()] == ["A"]
    assert [r.p for r in hot["p"].collect()] == ["P"]


def test_hot_keys_equal_exact_counts(spark):
    """Far more values than counters; keys of several types, nulls, none hot."""
    from tidewater.operators import hot_keys
    df = spark.range(0, 120_000, 1, 9).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None)
         .when(F.col("id") % 8 == 1, "warm").otherwise(F.concat(F.lit("k"), "id")).alias("s"),
        F.when(F.col("id") % 2 == 0, F.lit(5)).otherwise(F.col("id")).alias("n"),
        (F.when(F.col("id") % 5 < 3, F.lit(2)).otherwise(F.col("id")) / 4).cast("decimal(20,2)").alias("d"),
        F.col("id").alias("u"))
    hot = hot_keys(df, ["s", "n", "d", "u"], partitions=64, min_hot_rows=100)
    for k in ("s", "n", "d", "u"):
        want = {r[0] for r in df.groupBy(k).count().where(F.col(k).isNotNull())
                .where(F.col("count") > 4 * 120_000 / 64).collect()}
        assert {r[0] for r in hot[k].collect()} == want
        assert hot[k].columns == [k, "_tw_hot"] and hot[k].schema[k].dataType == df.schema[k].dataType
    none = hot_keys(df.where("u < 0"), ["s"], partitions=64)
    assert none["s"].count() == 0


def test_summaries_do_not_grow_with_the_values(spark):
    from tidewater.operators.joins import _summaries
    sizes = []
    for n in (100_000, 1_000_000):
        df = spark.range(0, n, 1, 4).select(F.concat(F.lit("key-"), F.xxhash64("id")).alias("s"))
        rows = _summaries(df, ["s"], 1024).select(F.length("_tw_s0.sketch").alias("n"), "_tw_c").collect()
        assert len(rows) == 4 and sum(r["_tw_c"] for r in rows) == n
        sizes.append(max(r["n"] for r in rows))
    assert max(sizes) < 1024 * 64
