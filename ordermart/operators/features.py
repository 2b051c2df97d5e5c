"""Row-level features (#54-#62); all native expressions (no row UDF)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import floor_days, haversine_km, hours_between
from .clean import drop_raw_cols

PURCHASE = "order_purchase_timestamp"
DELIVERED = "order_delivered_customer_date"


def feature_exprs() -> dict:
    return {
        # #54
        "order_approval_time_h": hours_between("order_approved_at", PURCHASE),
        # #55
        "order_delivery_time": floor_days(DELIVERED, PURCHASE),
        # #56 (negative when early)
        "order_delay_time": floor_days(DELIVERED, "order_estimated_delivery_date"),
        # #57
        "product_dimensions": F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm"),
        # #58: delivered to the customer minus the seller's shipping limit
        "seller_delay": floor_days(DELIVERED, "shipping_limit_date"),
        # #59: customer pair first; the formula is symmetric
        "seller_customer_distance": haversine_km("customer_lat", "customer_lng", "seller_lat", "seller_lng"),
        # #60
        "delivery_review_time": floor_days("review_creation_date", DELIVERED),
        # #61
        "review_to_answer_time_h": hours_between("review_answer_timestamp", "review_creation_date"),
    }


def add_features(df: DataFrame, drop_raw: bool = True) -> DataFrame:
    """#62: the eight features in one projection, then #11."""
    out = df.withColumns(feature_exprs())
    return drop_raw_cols(out) if drop_raw else out
