"""The medallion layers as lazily built DataFrames, plus the re-runnable
layer jobs (A9-A11).

``Warehouse`` derives bronze from the test parquet tables and silver from
bronze, on demand, each frame built once per instance. Nothing is collected:
every accessor returns a lazy DataFrame. ``load_bronze``/``load_silver``/
``build_gold`` materialise the layers as parquet tables under a root folder
with an audit row per table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.functions import collated_columns
from tidewater.operators import even_buckets
from tidewater.plans import silver as silver_tf
from tidewater.sources import testdata as td
from tidewater.sources.audit import LoadAudit
from tidewater.sources.files import (CORRUPT, GEOLOCATION_FIELDS, GEOLOCATION_LINE,
                                     SELLER_FIELDS, SELLER_LINE, parse_geolocation_lines,
                                     parse_seller_lines, read_raw_lines, scan_delimited,
                                     scan_fields, scan_quoted, write_delimited, write_lines)
from tidewater.sources.snapshots import Buckets, Dealt, SnapshotTable, columns_ddl, read_table
from tidewater.schemas import BRONZE
from tidewater.session import staged, staging_dropped, staging_path

_BRONZE_BUILDERS = {
    "crm_cust_info": td.bronze_customers,
    "crm_cust_reviews": td.bronze_reviews,
    "finance_ord_payments": td.bronze_payments,
    "prd_item_details": td.bronze_products,
    "prd_translations": td.bronze_translations,
    "sales_ord_items": td.bronze_order_items,
    "sales_ord_details": td.bronze_orders,
}

# Header lines of the two raw-line sources.
SELLER_HEADER = "seller_id,seller_zip_code_prefix,seller_city,seller_state"
GEOLOCATION_HEADER = ("geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,"
                      "geolocation_city,geolocation_state")


class Warehouse:
    """Bronze and silver frames for one test-data folder. ``collation`` (ledger L1) is
    that of the silver text, by default binary."""

    def __init__(self, spark: SparkSession, sf_dir: str, collation: str | None = None):
        self.spark, self.sf_dir, self.collation = spark, sf_dir, collation
        self._bronze: dict[str, DataFrame] = {}
        self._silver: dict[str, DataFrame] = {}

    def raw_lines(self, name: str) -> DataFrame:
        if name == "prd_seller_details":
            return td.seller_lines(self.spark, self.sf_dir)
        if name == "reference_geolocation":
            return td.geolocation_lines(self.spark, self.sf_dir)
        raise KeyError(name)

    def bronze(self, name: str) -> DataFrame:
        if name not in self._bronze:
            if name == "prd_seller_details":
                df = parse_seller_lines(self.raw_lines(name))[0]
            elif name == "reference_geolocation":
                df = parse_geolocation_lines(self.raw_lines(name))[0]
            else:
                df = _BRONZE_BUILDERS[name](self.spark, self.sf_dir)
            self._bronze[name] = df
        return self._bronze[name]

    def silver(self, name: str) -> DataFrame:
        if name not in self._silver:
            self._silver[name] = silver_tf.transform(name, self.bronze(name), self.collation)
        return self._silver[name]


class MaterializedLayer:
    """A layer read back from the tables written by the jobs below, in the version
    that is current when a table is first asked for: a load that comes between
    two queries on one layer object isn't seen."""

    materialized = True

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._held: dict[str, tuple[DataFrame, Buckets | None]] = {}

    def _hold(self, name: str) -> tuple[DataFrame, Buckets | None]:
        if name not in self._held:
            table = SnapshotTable(self.spark, f"{self.root}/{name}")
            v = table.version()
            self._held[name] = ((read_table(self.spark, table.path), None) if v is None
                                else (table.read(v.number), v.buckets))
        return self._held[name]

    def silver(self, name: str) -> DataFrame:
        return self._hold(name)[0]

    bronze = silver

    def buckets(self, name: str) -> Buckets | None:
        """How the rows of a table are dealt; no bucketed column has a hot value."""
        return self._hold(name)[1]


# --- layer jobs ---------------------------------------------------------------

QUOTED_SOURCES = ("crm_cust_reviews",)  # the only source with quoted text fields
LINE_SOURCES = {"prd_seller_details": SELLER_HEADER, "reference_geolocation": GEOLOCATION_HEADER}


def export_sources(wh: Warehouse, src_root: str) -> None:
    """Write the derived source tables as the files a source system would
    deliver: plain CSV, quoted CSV for reviews, raw lines for the two broken
    sources."""
    spark = wh.spark
    for name in BRONZE:
        path = f"{src_root}/{name}"
        if name in LINE_SOURCES:
            header = spark.createDataFrame([(LINE_SOURCES[name],)], "value string")
            write_lines(header.unionByName(wh.raw_lines(name)), path)
        else:
            write_delimited(wh.bronze(name), path, quoted=name in QUOTED_SOURCES)


LINE_FIELDS = {"prd_seller_details": (SELLER_LINE, SELLER_FIELDS),
               "reference_geolocation": (GEOLOCATION_LINE, GEOLOCATION_FIELDS)}


def scan_source(spark: SparkSession, src_root: str, name: str) -> DataFrame:
    """One source folder by the reader its format needs: the declared fields, and
    malformed records in ``_corrupt_record``."""
    path = f"{src_root}/{name}"
    if name in LINE_SOURCES:
        return scan_fields(read_raw_lines(spark, path, header=LINE_SOURCES[name]), *LINE_FIELDS[name])
    if name in QUOTED_SOURCES:
        return scan_quoted(spark, path, BRONZE[name])
    return scan_delimited(spark, path, BRONZE[name])


def load_bronze_table(spark: SparkSession, src_root: str, bronze_root: str, name: str,
                      audit: LoadAudit, max_rejects: int | None = None) -> DataFrame:
    """One source folder -> the next version of its bronze table, malformed
    records (``SnapshotTable.rejects``) beside the rows, in one pass."""
    return audit.load("bronze", name, SnapshotTable(spark, f"{bronze_root}/{name}"),
                      lambda: scan_source(spark, src_root, name), BRONZE[name].fieldNames(),
                      CORRUPT, max_rejects)


def load_bronze(spark: SparkSession, src_root: str, bronze_root: str,
                audit: LoadAudit | None = None, max_rejects: int | None = None,
                resume: bool = False) -> LoadAudit:
    """A11 ``load_bronze``: every source file -> a new version of its bronze table.
    More than ``max_rejects`` malformed records in one table fail the batch after
    recording it (no limit by default); that table keeps its rows. ``resume`` goes
    on after such a failure: tables that ``audit`` has as loaded are left alone."""
    audit = audit or LoadAudit()
    done = audit.loaded() if resume else set()
    for name in BRONZE:
        if ("bronze", name) not in done:
            load_bronze_table(spark, src_root, bronze_root, name, audit, max_rejects)
    return audit


#: Tables that are joined and aggregated by order: the column they are dealt by.
BUCKETED = {"sales_ord_details": "order_id", "sales_ord_items": "order_id",
            "finance_ord_payments": "order_id", "crm_cust_reviews": "order_id"}


def deal(df: DataFrame, name: str, number: int) -> Buckets | None:
    """The buckets of one silver table: ``number`` by its column in ``BUCKETED``, none
    for other tables, for a collated column, and where one value (or null) holds so
    much that its bucket would be an oversized task; such a table stays plain, and
    its readers salt its keys instead. Reviews are one row an order, so their orders
    needn't be counted."""
    column = BUCKETED.get(name)
    if not column or not number or collated_columns(df, [column]):
        return None
    if name != "crm_cust_reviews" and not even_buckets(df, column, number):
        return None
    return Buckets(column, number)


def once(df: DataFrame, name: str, number: int) -> DataFrame:
    """``df``, the items as a staged table. Those with a hot order before the dedupe are
    read twice after it (``deal`` looks again) and would be deduplicated each time."""
    if name != "sales_ord_items" or not number or collated_columns(df, [BUCKETED[name]]):
        return df
    return staged(df, staging_path(df.sparkSession, "items"))


def silver_rows(name: str, bronze: DataFrame, number: int,
                collation: str | None = None) -> tuple[DataFrame, Buckets | None]:
    """The silver rows of one bronze table and their buckets. Items and reviews whose
    orders are spread evenly with their duplicates are dealt once, before the dedupe;
    of others the dedupe folds what it can before its shuffle, and ``deal`` decides."""
    if name in silver_tf.ORDERED and number and not collation and not collated_columns(bronze):
        early = Dealt(BUCKETED[name], number)
        if even_buckets(silver_tf.ORDERED[name][0](bronze), early.column, number):
            return silver_tf.transform(name, bronze, buckets=early), early
    df = once(silver_tf.transform(name, bronze, collation), name, number)
    return df, deal(df, name, number)


def load_silver(spark: SparkSession, bronze_root: str, silver_root: str,
                audit: LoadAudit | None = None, resume: bool = False,
                buckets: int | None = None, collation: str | None = None) -> LoadAudit:
    """A11 ``load_silver``: every bronze table -> the next version of its silver table.
    The tables with an order id are dealt by it into ``buckets`` buckets (by default
    as many as the session's shuffle partitions, 0 for none), so the facts join and
    aggregate them without a shuffle. ``collation`` is that of the silver text."""
    number = int(spark.conf.get("spark.sql.shuffle.partitions")) if buckets is None else buckets
    audit = audit or LoadAudit()
    bronze = MaterializedLayer(spark, bronze_root)
    done = audit.loaded() if resume else set()
    for name in silver_tf.TRANSFORMS:
        if ("silver", name) not in done:
            with staging_dropped(spark):
                audit.load("silver", name, SnapshotTable(spark, f"{silver_root}/{name}"),
                           lambda name=name: silver_rows(name, bronze.bronze(name), number, collation))
    return audit


GOLD_MODELS = ("dim_customer", "dim_seller", "dim_products", "fact_sales", "fact_sales_items")


def build_gold(spark: SparkSession, silver_root: str, gold_root: str,
               audit: LoadAudit | None = None, views: bool = True, resume: bool = False) -> LoadAudit:
    """Materialise the gold models from silver tables (A7) and publish each as a
    temp view ``gold_<model>``. Surrogate keys (ledger L12) come from the key maps
    under ``<gold_root>/_keys``: a member keeps its key in every later build. The
    v2 dimensions are the v1 ones (J5-J7). ``resume`` leaves alone the models that
    ``audit`` has as built."""
    from tidewater.plans import gold  # local: gold imports operators that stage under the session

    audit = audit or LoadAudit()
    layer = GoldBuild(spark, silver_root, gold_root)
    done = audit.loaded() if resume else set()
    for model in GOLD_MODELS:   # dimensions first: the item fact reuses dim_customer
        table = SnapshotTable(spark, f"{gold_root}/{model}")
        if ("gold", model) in done:
            out = table.read()
        else:
            with staging_dropped(spark):
                out = audit.load("gold", model, table, lambda model=model: getattr(gold, model)(layer))
        layer.built.add(model)
        if views:
            out.createOrReplaceTempView(f"gold_{model}")
    return audit


class GoldBuild(MaterializedLayer):
    """Silver tables plus the gold models built so far."""

    def __init__(self, spark: SparkSession, silver_root: str, gold_root: str):
        super().__init__(spark, silver_root)
        self.gold_root, self.built = gold_root.rstrip("/"), set()

    def key_map(self, model: str) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.gold_root}/_keys/{model}")

    def gold_table(self, name: str) -> DataFrame | None:
        return read_table(self.spark, f"{self.gold_root}/{name}") if name in self.built else None


# The gold_v2 names of the source and the models they map to
# (v2 shares the v1 dimensions; its fact is the item-grain one).
GOLD_V2_VIEWS = {"dim_customer": "dim_customer", "dim_seller": "dim_seller",
                 "dim_products": "dim_products", "fact_sales": "fact_sales_items"}


def register_catalog(spark: SparkSession, bronze_root: str, silver_root: str,
                     gold_root: str) -> None:
    """Layer namespaces (A8) and published tables (A7): ``bronze``,
    ``silver`` and ``gold`` databases with the current versions' folders as
    external tables (register again after a load), and ``gold_v2`` views, so that SQL written against the
    source's schema names (``SELECT COUNT(*) FROM gold.fact_sales``) runs
    unchanged through ``spark.sql``. Nothing is copied."""
    from tidewater.schemas import BRONZE as tables

    layers = {"bronze": (bronze_root, tables), "silver": (silver_root, tables),
              "gold": (gold_root, GOLD_MODELS)}
    for db, (root, names) in layers.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root.rstrip('/')}'")
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {db}.{name}")
            table = SnapshotTable(spark, f"{root.rstrip('/')}/{name}")
            v = table.version()
            spark.sql(f"CREATE TABLE {db}.{name} ({columns_ddl(v.schema)}) USING parquet "
                      f"{v.buckets.clause if v.buckets else ''} LOCATION '{table.rows_folder()}'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS gold_v2 LOCATION '{gold_root.rstrip('/')}/_v2'")
    for view, model in GOLD_V2_VIEWS.items():
        spark.sql(f"CREATE OR REPLACE VIEW gold_v2.{view} AS SELECT * FROM gold.{model}")
