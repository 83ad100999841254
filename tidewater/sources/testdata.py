"""Bronze-shaped source tables derived from the driver's TPC-H-like parquet.

The reference's own source CSVs are not shipped, so the nine e-commerce source
tables are derived from the test tables with DataFrame code (one scan each,
column-pruned, no cross joins: fan-out uses ``explode``). They carry the same
defects the reference cleans: stray quotes, padded text, snake_case labels,
day-first date strings, an impossible date, duplicate rows and CSV lines with
commas inside a field. The matching SQL lives in ``tidewater.plans.spec_sql``.

TPC-H fixes ``nation`` (25 rows) and ``region`` (5 rows) at every scale
factor, so broadcasting them has a proven bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")

# Declared schemas of the test tables this library reads: a declared schema
# skips the footer-reading job that schema inference runs on every read.
TEST_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}

DAY_FIRST_OUT = "dd-MM-yyyy HH:mm"


_SCAN_SPLITS: dict[str, int] = {}


def spread_thin(df: DataFrame, splits: int) -> DataFrame:
    """Spread a scan that yields fewer partitions than the session's
    parallelism (a small file with one row group is read by one task) over
    all cores. On large inputs the scan already has enough splits and this is
    a no-op; on thin ones it costs one small shuffle and buys parallel
    map-side work (parsing, formatting, partial aggregation). Hashing on the
    leading (key) column keeps the spread deterministic without the local
    sort a round-robin repartition needs, and lets column pruning pass."""
    parallelism = df.sparkSession.sparkContext.defaultParallelism
    return df if splits >= parallelism else df.repartition(parallelism, df.columns[0])


# TPC-H fixes these at 25 and 5 rows for every scale factor: never worth spreading.
FIXED_SIZE_TABLES = ("nation", "region")


def read_test_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    reader = spark.read.schema(TEST_SCHEMAS[name]) if name in TEST_SCHEMAS else spark.read
    df = reader.parquet(path)
    if name in FIXED_SIZE_TABLES:
        return df
    if path not in _SCAN_SPLITS:   # planning only, no job; once per table
        _SCAN_SPLITS[path] = df.rdd.getNumPartitions()
    return spread_thin(df, _SCAN_SPLITS[path])


def _plus(ts: Column, unit: str, qty: Column) -> Column:
    return F.timestamp_add(unit, qty, ts)


def _iso(ts: Column) -> Column:
    """A timestamp as text to the second."""
    return F.substring_index(ts.cast("string"), ".", 1)


def _pad(c: Column, width: int) -> Column:
    return F.lpad(c.cast("string"), width, "0")


def _nation_region(spark, sf_dir) -> DataFrame:
    nation = read_test_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_test_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)


def bronze_customers(spark, sf_dir) -> DataFrame:
    """One customer_id per order, many per unique customer; every 97th row has
    an id that no order carries, so its order has no customer."""
    o = read_test_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    prefix = F.when(F.col("o_orderkey") % 97 == 0, "gone").otherwise("cid")
    c = read_test_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nr = _nation_region(spark, sf_dir)
    j = o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(nr), F.col("c_nationkey") == nr.n_nationkey)
    return j.select(
        F.concat(prefix, _pad(F.col("o_orderkey"), 8)).alias("customer_id"),
        F.concat(F.lit("u"), _pad(F.col("c_custkey"), 8)).alias("customer_unique_id"),
        _pad((F.col("o_orderkey") % 3 + F.col("c_custkey")) % 200, 5).alias("customer_zip_code"),
        F.col("n_name").alias("customer_city"),
        F.col("r_name").alias("customer_state"))


def bronze_orders(spark, sf_dir) -> DataFrame:
    """Order headers with day-first text timestamps; every 13th order is not
    delivered, every 211th has an impossible approval date."""
    o = read_test_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    purchase = _plus(d, "HOUR", k % 24)
    fmt = lambda ts: F.date_format(ts, DAY_FIRST_OUT)
    delivered = k % 13 != 0
    return o.select(
        k.cast("string").alias("order_id"),
        F.concat(F.lit("cid"), _pad(k, 8)).alias("customer_id"),
        F.when(F.col("o_orderstatus") == "F", "delivered")
         .when(F.col("o_orderstatus") == "O", "shipped").otherwise("invoiced").alias("order_status"),
        fmt(purchase).alias("order_purchase_timestamp"),
        F.when(k % 211 == 0, F.lit("31-02-2017 10:00"))
         .when(k % 29 != 0, fmt(_plus(d, "HOUR", k % 24 + 1 + k % 5))).alias("order_approved_at"),
        F.when(delivered, fmt(_plus(d, "DAY", k % 3 + 1))).alias("order_delivered_carrier_date"),
        F.when(delivered, fmt(_plus(_plus(d, "DAY", (k * 7) % 36), "HOUR", k % 24)))
         .alias("order_delivered_customer_date"),
        fmt(_plus(d, "DAY", F.lit(21))).alias("order_estimated_delivery_date"))


def bronze_order_items(spark, sf_dir) -> DataFrame:
    """Order lines; every line of a part divisible by 10 is repeated under
    another order_item_id (the silver dedupe drops it); ids carry a stray quote."""
    li = read_test_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_tax",
        "l_shipdate")
    copies = F.when(F.col("l_partkey") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    li = li.withColumn("k", F.explode(copies))
    return li.select(
        F.concat(F.lit('"'), F.col("l_orderkey").cast("string")).alias("order_id"),
        (F.col("l_linenumber") + F.lit(100) * F.col("k")).cast("int").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        _iso(F.col("l_shipdate")).alias("shipping_limit_date"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("price"),
        (F.col("l_tax") * 100).cast("decimal(10,2)").alias("freight_value"))


def bronze_payments(spark, sf_dir) -> DataFrame:
    """Every 10th order pays in three parts; the payment of every 101st names
    an order that doesn't exist."""
    o = read_test_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    k = F.col("o_orderkey")
    o = o.withColumn("seq", F.explode(F.sequence(F.lit(1), F.when(k % 10 == 0, 3).otherwise(1))))
    kind = (k + F.col("seq")) % 4
    return o.select(
        F.concat(F.when(k % 3 == 0, '"').otherwise(""), F.when(k % 101 == 0, "x").otherwise(""),
                 k.cast("string")).alias("order_id"),
        F.col("seq").cast("int").alias("payment_sequential"),
        F.when(kind == 0, "credit_card").when(kind == 1, "boleto").when(kind == 2, "voucher")
         .otherwise("debit_card").alias("payment_type"),
        (F.lit(1) + (k % 5) * F.when(F.col("seq") == 1, 1).otherwise(0)).cast("int")
         .alias("payment_installments"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("payment_value"))


def bronze_reviews(spark, sf_dir) -> DataFrame:
    """Every 7th order has two reviews (the later one wins); those of every 11th
    name an order that doesn't exist; padded titles; messages with commas and
    quotes."""
    o = read_test_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    k, d, prio = F.col("o_orderkey"), F.col("o_orderdate"), F.col("o_orderpriority")
    o = o.withColumn("n", F.explode(F.sequence(F.lit(1), F.when(k % 7 == 0, 2).otherwise(1))))
    n = F.col("n")
    return o.select(
        F.concat(F.lit("r"), k.cast("string"), F.lit("-"), n.cast("string")).alias("review_id"),
        F.concat(F.when(k % 11 == 0, "x").otherwise(""), k.cast("string")).alias("order_id"),
        (F.lit(1) + (k * 3 + n) % 5).cast("int").alias("review_score"),
        F.when(k % 2 == 0, F.concat(F.lit(" "), prio, F.lit(" "))).alias("review_title"),
        F.when(k % 3 != 0, F.concat(F.lit("Order "), k.cast("string"), F.lit(', priority "'),
                                     prio, F.lit('"'))).alias("review_message"),
        _plus(d, "DAY", n + 30).cast("date").cast("string").alias("review_creation_date"),
        _iso(_plus(_plus(d, "DAY", n + 32), "HOUR", k % 24))
         .alias("review_answer_date"))


def _category(p_type: Column, p_brand: Column) -> Column:
    return F.concat(F.lower(p_type), F.lit("_"), F.lower(F.replace(p_brand, F.lit("#"), F.lit("_"))))


def bronze_products(spark, sf_dir) -> DataFrame:
    """Products; snake_case categories (null for every 50th) and null attributes;
    a negative weight for every 31st."""
    p = read_test_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type",
                                                        "p_size", "p_retailprice")
    k, size = F.col("p_partkey"), F.col("p_size")
    return p.select(
        F.concat(F.when(k % 9 == 0, '"').otherwise(""), k.cast("string")).alias("product_id"),
        F.when(k % 50 != 0, _category(F.col("p_type"), F.col("p_brand"))).alias("product_category_name"),
        F.length("p_name").cast("int").alias("product_name_length"),
        F.when(k % 23 != 0, size * 10).cast("int").alias("product_description_length"),
        F.when(k % 17 != 0, size).cast("int").alias("product_photos_qty"),
        (F.floor("p_retailprice") * F.when(k % 31 == 0, -1).otherwise(1)).cast("int")
         .alias("product_weight_g"),
        (size + 1).cast("int").alias("product_length_cm"),
        F.when(k % 19 != 0, size + 2).cast("int").alias("product_height_cm"),
        (size + 3).cast("int").alias("product_width_cm"))


def bronze_translations(spark, sf_dir) -> DataFrame:
    """Category -> English; those of PROMO are filed under a name no product
    has; ECONOMY categories have two translations."""
    p = read_test_table(spark, sf_dir, "part").select("p_type", "p_brand")
    lang = F.explode(F.when(F.col("p_type") == "ECONOMY", F.array(F.lit("en_"), F.lit("uk_")))
                     .otherwise(F.array(F.lit("en_"))))
    return p.select("p_type", "p_brand", lang.alias("lang")).select(
        F.concat(F.when(F.col("p_type") == "PROMO", "old_").otherwise(""),
                 _category(F.col("p_type"), F.col("p_brand"))).alias("product_category_name"),
        F.concat("lang", F.lower("p_type"), F.lit("_"), F.lower("p_brand"))
         .alias("product_category_name_english")).distinct()


def seller_lines(spark, sf_dir) -> DataFrame:
    """Raw seller CSV lines (value): a stray quote on the id and, for every 4th
    seller, a comma inside the city."""
    s = read_test_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nr = _nation_region(spark, sf_dir)
    j = s.join(F.broadcast(nr), s.s_nationkey == nr.n_nationkey)
    k = F.col("s_suppkey")
    return j.select(F.concat(
        F.lit('"'), k.cast("string"), F.lit(","), _pad(k % 40, 5), F.lit(","), F.lower("n_name"),
        F.when(k % 4 == 0, F.concat(F.lit(", "), F.lower("r_name"))).otherwise(""),
        F.lit(","), F.upper(F.substring("r_name", 1, 2))).alias("value"))


def geolocation_lines(spark, sf_dir) -> DataFrame:
    """Raw geolocation CSV lines: two exact copies per supplier, several
    coordinates per zip, a stray quote on the zip, commas inside some cities."""
    s = read_test_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nr = _nation_region(spark, sf_dir)
    j = s.join(F.broadcast(nr), s.s_nationkey == nr.n_nationkey) \
         .withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    k = F.col("s_suppkey")
    return j.select(F.concat(
        F.lit('"'), _pad(k % 32, 5), F.lit(",-"), (k % 7 + 10).cast("string"), F.lit(".5,-"),
        (k % 5 + 40).cast("string"), F.lit(".25,"), F.lower("n_name"),
        F.when(k % 6 == 0, F.concat(F.lit(", "), F.lower("r_name"))).otherwise(""),
        F.lit(","), F.upper(F.substring("n_name", 1, 2))).alias("value"))
