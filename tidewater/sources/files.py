"""File sources for the bronze layer (A1-A4), delivery writers, and the two
positional line parsers (I1, I2).

Readers always take a declared schema. Bad input is routed to a rejects
DataFrame instead of failing the whole load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewater.functions.code_pages import byte_text, decode_bytes, is_undecodable
from tidewater.session import package_on_workers
from tidewater.sources.quoted import CORRUPT, read_quoted

# Positional layouts of the two broken sources. The first
# fields and the last field never contain commas; everything between them
# is the city, commas included.
SELLER_LINE = r"^([^,]*),([^,]*),(.*),([^,]*)$"
SELLER_FIELDS = ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")
GEOLOCATION_LINE = r"^([^,]*),([^,]*),([^,]*),(.*),([^,]*)$"
GEOLOCATION_FIELDS = ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
                      "geolocation_city", "geolocation_state")


def _with_corrupt(schema: StructType) -> StructType:
    return StructType(list(schema.fields) + [StructField(CORRUPT, StringType(), True)])


def _split_rejects(df: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    good = df.where(F.col(CORRUPT).isNull()).select(*schema.fieldNames())
    # The rejects keep the parsed fields next to the raw line: Spark refuses
    # scans whose only referenced column is the corrupt-record column.
    bad = df.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"),
                                                       *schema.fieldNames())
    return good, bad


def scan_delimited(spark: SparkSession, path: str, schema: StructType,
                   sep: str = ",") -> DataFrame:
    """Header-skipping delimited load with quoting turned off (A1): the fields,
    and in ``_corrupt_record`` a line whose fields do not fit the schema.
    The default line separator drops a CR of CRLF files and a leading BOM."""
    return (spark.read.schema(_with_corrupt(schema))
            .option("header", True).option("sep", sep).option("quote", "")
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .csv(path))


def scan_quoted(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """RFC-4180 CSV (A2): quoted fields, doubled quotes inside, line breaks inside
    quotes; the fields, and in ``_corrupt_record`` a record that doesn't fit.
    Files are read in as many tasks as they have splits."""
    package_on_workers(spark)
    return read_quoted(spark, path, schema)


def read_delimited(spark: SparkSession, path: str, schema: StructType,
                   sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """``scan_delimited`` as (rows, rejects).
    Spark refuses a query on the file whose only column is the corrupt-record
    column (``rows.count()``, ``rejects.count()``): land the rows first
    (as ``load_bronze`` does), cache them, or count records and rows
    separately."""
    return _split_rejects(scan_delimited(spark, path, schema, sep), schema)


def read_quoted_csv(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """``scan_quoted`` as (rows, rejects)."""
    return _split_rejects(scan_quoted(spark, path, schema), schema)


def read_raw_lines(spark: SparkSession, path: str, header: str | None = None) -> DataFrame:
    """Whole lines into one ``value`` column (A3). The header is dropped by its
    text, not by position, so split files stay correct."""
    df = spark.read.text(path)
    return df if header is None else df.where(F.col("value") != F.lit(header))


def read_code_page_lines(spark: SparkSession, path: str, charset: str,
                         header: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Lines of a file in a single-byte code page (A3, L16): decoded lines, and as
    rejects the lines with a byte that the code page doesn't define, each byte
    shown as the character of its number. The line ends are the same bytes
    in every code page, so the file is split as any text file."""
    raw = F.col("value").cast("binary")
    lines = spark.read.text(path)
    good = lines.where(~is_undecodable(raw, charset)).select(decode_bytes(raw, charset).alias("value"))
    bad = lines.where(is_undecodable(raw, charset)).select(byte_text(raw).alias("value"))
    return (good if header is None else good.where(F.col("value") != F.lit(header))), bad


def scan_fields(lines: DataFrame, pattern: str, fields) -> DataFrame:
    """The fields of lines (value) by position, and in ``_corrupt_record`` a line
    that the pattern doesn't fit."""
    v = F.col("value")
    fits = F.coalesce(v.rlike(pattern), F.lit(False))
    return lines.select(
        *[F.when(fits, F.regexp_extract(v, pattern, i + 1)).alias(f) for i, f in enumerate(fields)],
        F.when(~fits, F.coalesce(v, F.lit(""))).alias(CORRUPT))


def _parse(lines: DataFrame, pattern: str, fields) -> tuple[DataFrame, DataFrame]:
    v = F.col("value")
    matched = lines.where(v.rlike(pattern))
    parsed = matched.select(*[F.regexp_extract(v, pattern, i + 1).alias(f)
                              for i, f in enumerate(fields)])
    rejects = lines.where(~v.rlike(pattern) | v.isNull())
    return parsed, rejects


def parse_seller_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """First field id, second zip, last state, everything between is the city
    (I1). Lines with fewer than four fields are rejects."""
    return _parse(lines, SELLER_LINE, SELLER_FIELDS)


def parse_geolocation_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """First three fields zip, lat, lng; last state; between is the city."""
    return _parse(lines, GEOLOCATION_LINE, GEOLOCATION_FIELDS)


def write_delimited(df: DataFrame, path: str, quoted: bool = False) -> None:
    """Write a CSV with a header, blanks kept as they are. ``quoted`` writes
    RFC-4180 quoting (doubled quotes); otherwise no quoting at all."""
    w = (df.write.mode("overwrite").option("header", True)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    w = w.option("quote", '"').option("escape", '"') if quoted else w.option("quote", "")
    w.csv(path)


def write_lines(df: DataFrame, path: str) -> None:
    df.select("value").write.mode("overwrite").text(path)
