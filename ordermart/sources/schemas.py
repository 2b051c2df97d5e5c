"""Explicit schemas of the raw marketplace tables.

Raw (as delivered in CSV): every time column is text and is retyped by the
cleaning operators. Clean: the target types used by the mart.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, I, L, TS = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.TimestampNTZType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


ORDER_TIME_COLS = [
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
]
REVIEW_TIME_COLS = ["review_creation_date", "review_answer_timestamp"]
ITEM_TIME_COLS = ["shipping_limit_date"]

CLEAN = {
    "orders": _schema(("order_id", S), ("customer_id", S), ("order_status", S),
                      *[(c, TS) for c in ORDER_TIME_COLS]),
    "customers": _schema(("customer_id", S), ("customer_unique_id", S),
                         ("customer_zip_code_prefix", S), ("customer_city", S),
                         ("customer_state", S)),
    "order_items": _schema(("order_id", S), ("order_item_id", L), ("product_id", S),
                           ("seller_id", S), ("shipping_limit_date", TS), ("price", D),
                           ("freight_value", D)),
    "products": _schema(("product_id", S), ("product_category_name", S),
                        ("product_name_lenght", D), ("product_description_lenght", D),
                        ("product_weight_g", D), ("product_length_cm", D),
                        ("product_height_cm", D), ("product_width_cm", D)),
    "sellers": _schema(("seller_id", S), ("seller_zip_code_prefix", S), ("seller_city", S),
                       ("seller_state", S)),
    "payments": _schema(("order_id", S), ("payment_sequential", I), ("payment_type", S),
                        ("payment_installments", I), ("payment_value", D)),
    "reviews": _schema(("order_id", S), ("review_score", D), ("review_comment_title", S),
                       ("review_comment_message", S), *[(c, TS) for c in REVIEW_TIME_COLS]),
    "geolocation": _schema(("geolocation_zip_code_prefix", S), ("geolocation_lat", D),
                           ("geolocation_lng", D), ("geolocation_city", S),
                           ("geolocation_state", S)),
    "category_translation": _schema(("product_category_name", S),
                                    ("product_category_name_english", S)),
}

# Raw text layout: the same columns, time columns still VARCHAR.
_TIME_COLS = set(ORDER_TIME_COLS + REVIEW_TIME_COLS + ITEM_TIME_COLS)
RAW = {
    name: T.StructType([
        T.StructField(f.name, S if f.name in _TIME_COLS else f.dataType, True) for f in sch.fields
    ])
    for name, sch in CLEAN.items()
}

TABLES = list(CLEAN)
