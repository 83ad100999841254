"""Declared schemas of the warehouse tables (A4). Never inferred.

Bronze keeps text as text (dates included); silver types the dates.
Lengths of the source VARCHARs are not types here; they are quality rules.
"""

from __future__ import annotations

from pyspark.sql.types import (DateType, DecimalType, IntegerType, StringType, StructField,
                               StructType, TimestampNTZType)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


S, I, D2 = StringType(), IntegerType(), DecimalType(10, 2)
DT, TS = DateType(), TimestampNTZType()

BRONZE = {
    "crm_cust_info": _s(("customer_id", S), ("customer_unique_id", S), ("customer_zip_code", S),
                        ("customer_city", S), ("customer_state", S)),
    "crm_cust_reviews": _s(("review_id", S), ("order_id", S), ("review_score", I),
                           ("review_title", S), ("review_message", S),
                           ("review_creation_date", S), ("review_answer_date", S)),
    "finance_ord_payments": _s(("order_id", S), ("payment_sequential", I), ("payment_type", S),
                               ("payment_installments", I), ("payment_value", D2)),
    "prd_seller_details": _s(("seller_id", S), ("seller_zip_code_prefix", S),
                             ("seller_city", S), ("seller_state", S)),
    "prd_item_details": _s(("product_id", S), ("product_category_name", S),
                           ("product_name_length", I), ("product_description_length", I),
                           ("product_photos_qty", I), ("product_weight_g", I),
                           ("product_length_cm", I), ("product_height_cm", I),
                           ("product_width_cm", I)),
    "prd_translations": _s(("product_category_name", S), ("product_category_name_english", S)),
    "reference_geolocation": _s(("geolocation_zip_code_prefix", S), ("geolocation_lat", S),
                                ("geolocation_lng", S), ("geolocation_city", S),
                                ("geolocation_state", S)),
    "sales_ord_items": _s(("order_id", S), ("order_item_id", I), ("product_id", S),
                          ("seller_id", S), ("shipping_limit_date", S), ("price", D2),
                          ("freight_value", D2)),
    "sales_ord_details": _s(("order_id", S), ("customer_id", S), ("order_status", S),
                            ("order_purchase_timestamp", S), ("order_approved_at", S),
                            ("order_delivered_carrier_date", S),
                            ("order_delivered_customer_date", S),
                            ("order_estimated_delivery_date", S)),
}

# Raw staging tables: the whole source line in one column (A3).
RAW_LINE = _s(("value", S))

SILVER = dict(BRONZE)
SILVER.update({
    "crm_cust_reviews": _s(("review_id", S), ("order_id", S), ("review_score", I),
                           ("review_title", S), ("review_message", S),
                           ("review_creation_date", DT), ("review_answer_date", TS)),
    "sales_ord_items": _s(("order_id", S), ("order_item_id", I), ("product_id", S),
                          ("seller_id", S), ("shipping_limit_date", TS), ("price", D2),
                          ("freight_value", D2)),
    "sales_ord_details": _s(("order_id", S), ("customer_id", S), ("order_status", S),
                            ("order_purchase_timestamp", TS), ("order_approved_at", TS),
                            ("order_delivered_carrier_date", TS),
                            ("order_delivered_customer_date", TS),
                            ("order_estimated_delivery_date", DT)),
})

TABLES = tuple(BRONZE)
