"""The wide order mart (#10, #33-#41).

Join layout chosen for a cluster (Catalyst/AQE pick the physical joins):

* dimension side first: customers and sellers get their zip row from the
  small zip dimension, items get product and seller attributes. These are
  N:1 lookups, so none of them multiplies rows;
* the order-grain side last: orders, items, payments and reviews all join
  on ``order_id``, so the fan-out joins share one hash partitioning on the
  order key and the sort-merge joins need no exchange between them;
* sellers of up to ``SELLER_ROWS`` rows are broadcast after that, whatever the
  session's threshold for broadcasts: items are then not dealt by seller, and
  the seller's place is not moved with them.

The result has one row per order x item x payment x review (T7).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import session
from . import geo
from .clean import drop_geo_cols

# The mart's columns.
MART_COLS = [
    "order_id", "customer_unique_id", "customer_city", "customer_state", "customer_lat",
    "customer_lng", "order_status", "order_purchase_timestamp", "order_approved_at",
    "order_delivered_carrier_date", "order_delivered_customer_date",
    "order_estimated_delivery_date", "order_item_id", "product_id", "product_category_name",
    "product_name_lenght", "product_description_lenght", "product_weight_g",
    "product_length_cm", "product_height_cm", "product_width_cm", "seller_id", "seller_city",
    "seller_state", "seller_lat", "seller_lng", "shipping_limit_date", "price",
    "freight_value", "payment_sequential", "payment_type", "payment_installments",
    "total_payment", "review_score", "review_comment_title", "review_comment_message",
    "review_creation_date", "review_answer_timestamp",
]

PRODUCT_ATTRS = ["product_category_name", "product_name_lenght", "product_description_lenght",
                 "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"]


def with_geo(df: DataFrame, zip_col: str, zip_geo: DataFrame, prefix: str) -> DataFrame:
    """#39/#40: left join an entity to the zip dimension, renaming the geo
    columns to ``{prefix}_city/_state/_lat/_lng``."""
    z = zip_geo.select(F.col(geo.ZIP).alias("_zip"),
                       F.col(geo.CITY).alias(f"{prefix}_city"),
                       F.col(geo.STATE).alias(f"{prefix}_state"),
                       F.col(geo.LAT).alias(f"{prefix}_lat"),
                       F.col(geo.LNG).alias(f"{prefix}_lng"))
    return df.join(z, df[zip_col] == z["_zip"], "left").drop("_zip", zip_col)


def with_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """#33: N:1, every order kept; the join key goes."""
    return orders.join(customers, "customer_id", "left").drop("customer_id")


def with_products(items: DataFrame, products: DataFrame) -> DataFrame:
    """#35: N:1; ``product_id`` becomes the product table's, NULL without a match."""
    p = products.select(F.col("product_id").alias("_p_id"), *PRODUCT_ATTRS)
    return items.join(p, items["product_id"] == p["_p_id"], "left") \
                .drop("product_id").withColumnRenamed("_p_id", "product_id")


def with_sellers(items: DataFrame, sellers: DataFrame) -> DataFrame:
    """#36: N:1; ``seller_id`` becomes the seller table's, NULL without a match."""
    s = sellers.withColumnRenamed("seller_id", "_s_id")
    return items.join(s, items["seller_id"] == s["_s_id"], "left") \
                .drop("seller_id").withColumnRenamed("_s_id", "seller_id")


def with_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """#34: fan-out on the order key."""
    return orders.join(items, "order_id", "left")


def with_payments(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """#37: fan-out on the order key; the value is named ``total_payment``."""
    pay = payments.select("order_id", "payment_sequential", "payment_type", "payment_installments",
                          F.col("payment_value").alias("total_payment"))
    return orders.join(pay, "order_id", "left")


def with_reviews(orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """#38: fan-out on the order key."""
    rev = reviews.select("order_id", "review_score", "review_comment_title", "review_comment_message",
                         "review_creation_date", "review_answer_timestamp")
    return orders.join(rev, "order_id", "left")


def order_side(orders: DataFrame, customers: DataFrame, zip_geo: DataFrame) -> DataFrame:
    """Orders with their customer and its place, a row per order."""
    cust = with_geo(drop_geo_cols(customers, "customer")
                    .select("customer_id", "customer_unique_id", "customer_zip_code_prefix"),
                    "customer_zip_code_prefix", zip_geo, "customer")
    return with_customers(orders, cust)


#: Rows of the seller table up to which it is broadcast.
SELLER_ROWS = 500_000


def seller_side(sellers: DataFrame, zip_geo: DataFrame) -> DataFrame:
    """Sellers with their place, a row per seller."""
    return with_geo(drop_geo_cols(sellers, "seller").select("seller_id", "seller_zip_code_prefix"),
                    "seller_zip_code_prefix", zip_geo, "seller")


def sold_products(items: DataFrame, products: DataFrame) -> DataFrame:
    """Items with their product, a row per item."""
    return with_products(items.select("order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date",
                                      "price", "freight_value"), products)


def item_side(items: DataFrame, products: DataFrame, sellers: DataFrame, zip_geo: DataFrame) -> DataFrame:
    """Items with their product, seller and its place, a row per item."""
    return with_sellers(sold_products(items, products), seller_side(sellers, zip_geo))


def fan_out(orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame) -> DataFrame:
    """#34, #37, #38: the three joins on the order key that multiply rows."""
    return with_reviews(with_payments(with_items(orders, items), payments), reviews)


def orders_master(orders: DataFrame, customers: DataFrame, items: DataFrame,
                  products: DataFrame, sellers: DataFrame, payments: DataFrame,
                  reviews: DataFrame, zip_geo: DataFrame, seller_rows: int = SELLER_ROWS) -> DataFrame:
    """#41: the 38-column mart, all joins LEFT OUTER as in the view. Counts the sellers (a small job)."""
    bought = order_side(orders, customers, zip_geo)
    if sellers.count() <= seller_rows:
        # an N:1 lookup by ``seller_id`` gives the same rows before and after the joins by order
        m = with_sellers(fan_out(bought, sold_products(items, products), payments, reviews),
                         F.broadcast(seller_side(sellers, zip_geo)))
    else:
        m = fan_out(bought, item_side(items, products, sellers, zip_geo), payments, reviews)
    return m.select(*MART_COLS)


def build_mart(tables: dict[str, DataFrame]) -> DataFrame:
    """Zip dimension + mart from the raw (already typed) tables."""
    zg = geo.build_zip_geo(tables["geolocation"], tables["customers"], tables["sellers"])
    return orders_master(tables["orders"], tables["customers"], tables["order_items"],
                         tables["products"], tables["sellers"], tables["payments"],
                         tables["reviews"], zg)


#: Rows of one order and table from which on a stored join is shuffled, so that AQE can split the order.
HOT_ORDER_ROWS = 1_000_000
#: Rows of the largest side in a bucket, about; more rows take more buckets.
BUCKET_ROWS = 500_000


@dataclass(frozen=True)
class StoredSides:
    """The four sides of the fan-out as bucketed tables of the catalog:
    name and folder per side, and the most rows an order has in one of them."""
    spark: SparkSession
    tables: dict[str, tuple[str, str]]
    largest_order: int

    def mart(self, hot_rows: int = HOT_ORDER_ROWS) -> DataFrame:
        """#41 from the stored sides. The buckets are the joins' partitioning,
        so no side is shuffled again (its sorted files pass a sort that finds
        them in order). A bucket is one task and can't be split: with an order above ``hot_rows`` the same files are read
        without their buckets, and AQE splits that order's partition."""
        hot = self.largest_order > hot_rows
        sides = {side: self.spark.read.parquet(path) if hot else self.spark.table(name)
                 for side, (name, path) in self.tables.items()}
        return fan_out(sides["orders"], sides["items"], sides["payments"], sides["reviews"]).select(*MART_COLS)

    def drop(self) -> None:
        """Forget the tables; their folders go with ``session.release``."""
        for name, _ in self.tables.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def store_sides(tables: dict[str, DataFrame], zip_geo: DataFrame, buckets: int = 200,
                bucket_rows: int = BUCKET_ROWS) -> StoredSides:
    """Write orders (with customers), items (with products and sellers),
    payments and reviews once, each bucketed and sorted by ``order_id``: one
    shuffle a side here, none in any mart built from them later. One file per
    bucket, so that its order holds; ``buckets`` is the least number, and a side
    of more than ``BUCKET_ROWS`` rows for each takes more, so that a task's
    bucket does not grow with the tables. Items, payments and reviews without an order key
    match nothing in a LEFT join and are not stored."""
    spark = zip_geo.sparkSession
    sides = {"orders": order_side(tables["orders"], tables["customers"], zip_geo),
             "items": item_side(tables["order_items"], tables["products"], tables["sellers"], zip_geo),
             "payments": tables["payments"], "reviews": tables["reviews"]}
    rows = max(tables[t].count() for t in ("orders", "order_items", "payments", "reviews"))
    buckets = max(buckets, -(-rows // bucket_rows))
    stored, largest = {}, 0
    for side, df in sides.items():
        name, path = f"{side}_{uuid.uuid4().hex}", session.scratch(spark).path()
        keyed = df if side == "orders" else df.where(F.col("order_id").isNotNull())
        (keyed.repartition(buckets, "order_id").sortWithinPartitions("order_id")
         .write.format("parquet").bucketBy(buckets, "order_id").sortBy("order_id").option("path", path).saveAsTable(name))
        stored[side] = (name, path)
        most = spark.table(name).groupBy("order_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        largest = max(largest, most or 0)
    return StoredSides(spark, stored, largest)


def build_mart_stored(tables: dict[str, DataFrame], buckets: int = 200) -> DataFrame:
    """Zip dimension + mart through the bucketed sides."""
    zg = geo.build_zip_geo(tables["geolocation"], tables["customers"], tables["sellers"])
    return store_sides(tables, zg, buckets).mart()


def register_mart_view(mart: DataFrame, name: str = "orders_master") -> DataFrame:
    """#5: expose the mart as a temp view (the SQL entry point)."""
    mart.createOrReplaceTempView(name)
    return mart


def mart_source(spark, mart: DataFrame | None = None, table: str = "orders_master") -> DataFrame:
    """#2: a caller-supplied mart, else the registered table/view."""
    return mart if mart is not None else spark.table(table)


def lookup_map(df: DataFrame, key: str, stats: DataFrame, stats_key: str, value: str,
               out: str) -> DataFrame:
    """#42: ``series.map(group_stat)`` -- an N:1 lookup of a per-key value.

    A left join on the key; rows whose key is NULL or absent get NULL (the
    stats table has one row per key, so no row is duplicated). AQE
    broadcasts the stats table when its runtime size allows.
    """
    s = stats.select(F.col(stats_key).alias("_lk"), F.col(value).alias(out))
    return df.join(s, df[key] == s["_lk"], "left").drop("_lk")


def group_mean(df: DataFrame, key: str, col: str) -> DataFrame:
    """Per-key mean of ``col`` (NULL keys dropped), the usual lookup table."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(col).alias(f"_mean_{col}"))
