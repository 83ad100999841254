"""Silver transforms (I3-I11): clean, type and deduplicate each bronze table.

Each transform reads one bronze table and is independent of the others, so
they can run as separate jobs. Only three of them shuffle (the dedupes of
reviews, geolocation and order items), and those use map-side partial
aggregation (see ``operators.dedupe``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import (collate, sentence_case, sentence_case_spaced, strict_date,
                                 strict_timestamp, strip_quotes, strip_quotes_trim,
                                 trim_or_na, try_parse_day_first, try_parse_day_first_date)
from tidewater.operators import drop_exact_duplicates, keep_first, keep_first_window
from tidewater.sources.snapshots import Buckets

PRODUCT_MEASURES = ("product_name_length", "product_description_length", "product_photos_qty",
                    "product_weight_g", "product_length_cm", "product_height_cm",
                    "product_width_cm")

ITEM_DEDUPE_KEY = ("order_id", "product_id", "seller_id", "shipping_limit_date", "price",
                   "freight_value")


def transform(name: str, bronze: DataFrame, collation: str | None = None,
              buckets: Buckets | None = None) -> DataFrame:
    """The silver rows of one bronze table. Under a ``collation`` (ledger L1) the cleaned
    text compares by it from then on: in the transform's own dedupe and in all that
    reads the result. ``buckets`` (of a table in ``ORDERED``, without a collation) deals the
    rows before the dedupe, which then needs no other shuffle and leaves them dealt."""
    if buckets is not None:
        typed, dedupe = ORDERED[name]
        return dedupe(typed(bronze).repartition(buckets.number, buckets.column))
    fn = TRANSFORMS[name]
    if fn in (reviews, geolocation, order_items):
        return fn(bronze, collation=collation)
    return collate(fn(bronze), collation)


def customers(b: DataFrame) -> DataFrame:
    """Sentence-case city."""
    return b.select("customer_id", "customer_unique_id", "customer_zip_code",
                    sentence_case("customer_city").alias("customer_city"), "customer_state")


def typed_reviews(b: DataFrame) -> DataFrame:
    """I4: trimmed text with 'n/a' for missing, typed dates."""
    return b.select(
        "review_id", "order_id", "review_score",
        trim_or_na("review_title").alias("review_title"),
        trim_or_na("review_message").alias("review_message"),
        strict_date("review_creation_date").alias("review_creation_date"),
        strict_timestamp("review_answer_date").alias("review_answer_date"))


def latest_reviews(typed: DataFrame) -> DataFrame:
    """I4: the latest review per order (creation, then answer date, then review_id,
    descending)."""
    return keep_first(typed, ["order_id"],
                      ["review_creation_date", "review_answer_date", "review_id"], descending=True)


def reviews(b: DataFrame, collation: str | None = None) -> DataFrame:
    """I4: the latest of the cleaned reviews."""
    return latest_reviews(collate(typed_reviews(b), collation))


def payments(b: DataFrame) -> DataFrame:
    """Unquoted order id, readable payment type."""
    return b.select(strip_quotes_trim("order_id").alias("order_id"), "payment_sequential",
                    sentence_case_spaced("payment_type").alias("payment_type"),
                    "payment_installments", "payment_value")


def products(b: DataFrame) -> DataFrame:
    """Unquoted id, readable category ('n/a' when missing), measures 0 when missing."""
    return b.select(
        strip_quotes_trim("product_id").alias("product_id"),
        F.coalesce(sentence_case_spaced("product_category_name"), F.lit("n/a"))
         .alias("product_category_name"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in PRODUCT_MEASURES])


def sellers(b: DataFrame) -> DataFrame:
    """Unquoted id and zip, sentence-case city, state untouched."""
    return b.select(strip_quotes_trim("seller_id").alias("seller_id"),
                    strip_quotes_trim("seller_zip_code_prefix").alias("seller_zip_code_prefix"),
                    sentence_case("seller_city").alias("seller_city"), "seller_state")


def translations(b: DataFrame) -> DataFrame:
    """I8: both names readable and trimmed, so they join to silver products."""
    return b.select(F.trim(sentence_case_spaced("product_category_name")).alias("product_category_name"),
                    F.trim(sentence_case_spaced("product_category_name_english"))
                     .alias("product_category_name_english"))


def geolocation(b: DataFrame, collation: str | None = None) -> DataFrame:
    """Quotes removed from the zip (no trim), sentence-case city, exact
    duplicates dropped (after cleaning, ledger L9)."""
    return drop_exact_duplicates(collate(b.select(
        strip_quotes("geolocation_zip_code_prefix").alias("geolocation_zip_code_prefix"),
        "geolocation_lat", "geolocation_lng",
        sentence_case("geolocation_city").alias("geolocation_city"), "geolocation_state"), collation))


def typed_items(b: DataFrame) -> DataFrame:
    """Unquoted ids, typed shipping limit."""
    return b.select(strip_quotes_trim("order_id").alias("order_id"), "order_item_id",
                    strip_quotes_trim("product_id").alias("product_id"),
                    strip_quotes_trim("seller_id").alias("seller_id"),
                    strict_timestamp("shipping_limit_date").alias("shipping_limit_date"),
                    "price", "freight_value")


def first_items_dealt(typed: DataFrame) -> DataFrame:
    """I10's dedupe of items that are dealt by order: each task sorts its rows, which the
    bucket's file needs anyway, and keeps the first of each key."""
    return keep_first_window(typed, list(ITEM_DEDUPE_KEY), [F.col("order_item_id").asc_nulls_last()])


def order_items(b: DataFrame, dedupe_key=ITEM_DEDUPE_KEY, collation: str | None = None) -> DataFrame:
    """One row per dedupe key, the lowest order_item_id kept. The default key
    omits order_item_id, as in the source (ledger L8); pass another key to change that."""
    return keep_first(collate(typed_items(b), collation), list(dedupe_key), ["order_item_id"])


def orders(b: DataFrame) -> DataFrame:
    """Sentence-case status, day-first timestamps parsed leniently (null
    when invalid), estimate from its first ten characters. No dedupe."""
    return b.select(
        "order_id", "customer_id",
        F.trim(sentence_case("order_status")).alias("order_status"),
        try_parse_day_first("order_purchase_timestamp").alias("order_purchase_timestamp"),
        try_parse_day_first("order_approved_at").alias("order_approved_at"),
        try_parse_day_first("order_delivered_carrier_date").alias("order_delivered_carrier_date"),
        try_parse_day_first("order_delivered_customer_date").alias("order_delivered_customer_date"),
        try_parse_day_first_date("order_estimated_delivery_date").alias("order_estimated_delivery_date"))


TRANSFORMS = {
    "crm_cust_info": customers,
    "crm_cust_reviews": reviews,
    "finance_ord_payments": payments,
    "prd_item_details": products,
    "prd_seller_details": sellers,
    "prd_translations": translations,
    "reference_geolocation": geolocation,
    "sales_ord_items": order_items,
    "sales_ord_details": orders,
}

#: Transforms that drop duplicates within an order: the cleaning and the dedupe.
ORDERED = {"crm_cust_reviews": (typed_reviews, latest_reviews), "sales_ord_items": (typed_items, first_items_dealt)}
