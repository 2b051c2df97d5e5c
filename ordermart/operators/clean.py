"""Cleaning: blank text to NULL, text to timestamps, dropping columns (#7-#9, #11, #12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import blank_to_null as _blank, text_to_timestamp as _to_ts
from ..sources.schemas import ITEM_TIME_COLS, ORDER_TIME_COLS, REVIEW_TIME_COLS


def blank_to_null(df: DataFrame, cols: list[str] = ORDER_TIME_COLS) -> DataFrame:
    """#7: blank text becomes NULL in ``cols`` (must run before the cast)."""
    return df.withColumns({c: _blank(c) for c in cols if c in df.columns})


def text_to_timestamp(df: DataFrame, cols: list[str], strict: bool = True) -> DataFrame:
    """#8: VARCHAR -> TIMESTAMP_NTZ (blank text is NULL first)."""
    return df.withColumns({c: _to_ts(c, strict) for c in cols if c in df.columns})


def clean_orders(df: DataFrame, strict: bool = True) -> DataFrame:
    return text_to_timestamp(blank_to_null(df, ORDER_TIME_COLS), ORDER_TIME_COLS, strict)


def clean_items(df: DataFrame, strict: bool = True) -> DataFrame:
    return text_to_timestamp(df, ITEM_TIME_COLS, strict)


def clean_reviews(df: DataFrame, strict: bool = True) -> DataFrame:
    return text_to_timestamp(df, REVIEW_TIME_COLS, strict)


def drop_geo_cols(df: DataFrame, prefix: str) -> DataFrame:
    """#9: city/state move to the zip dimension; dropped when present."""
    return df.drop(f"{prefix}_city", f"{prefix}_state")


# The columns that the features replace.
RAW_TIME_AND_GEO_COLS = [
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
    "product_length_cm", "product_height_cm", "product_width_cm", "shipping_limit_date",
    "review_creation_date", "review_answer_timestamp",
    "seller_lat", "seller_lng", "customer_lat", "customer_lng",
]


def drop_raw_cols(df: DataFrame) -> DataFrame:
    """#11: raw time, dimension and coordinate columns after the features."""
    return df.drop(*RAW_TIME_AND_GEO_COLS)


ID_COLS = ["order_id", "customer_unique_id", "product_id"]
TARGET = "bad_review"


def drop_ids_target(df: DataFrame) -> DataFrame:
    """#12: feature columns only (ids and target removed)."""
    return df.drop(TARGET, *ID_COLS)


def status_rows(df: DataFrame, statuses=("canceled", "unavailable")) -> DataFrame:
    """#25: rows with the given order statuses."""
    return df.where(F.col("order_status").isin(*statuses))
