"""Fixture adapter: the marketplace tables derived from the driver's tables.

The real marketplace CSVs are not available, so tests and benchmarks derive
the same schemas from ``orders lineitem part supplier customer events`` by
deterministic expressions (FIXTURES.md section 3). The DuckDB twin of every
expression lives in ``ordermart.plans.oracle`` and must stay in step.

Everything is lazy; Parquet scans get only the columns they need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import blank_to_null  # noqa: F401  (re-exported for callers)
from .schemas import ITEM_TIME_COLS, ORDER_TIME_COLS, REVIEW_TIME_COLS

# Fixed values of the adapter (FIXTURES.md): payment type by key % 4.
PAYMENT_TYPE_BY_MOD4 = ["boleto", "voucher", "credit_card", "credit_card"]


_READS: dict = {}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver table as a lazy DataFrame, one per session and path: the
    inputs are read-only, so the file listing and footer read happen once."""
    key = (id(spark), f"{sf_dir}/{name}.parquet")
    if key not in _READS:
        _READS[key] = spark.read.parquet(key[1])
    return _READS[key]


def _hours(ts: Column, n: Column | int) -> Column:
    return F.timestamp_add("HOUR", n if isinstance(n, Column) else F.lit(n), ts)


def zip_city(z: Column) -> Column:
    return F.when(z >= 195, F.concat(F.lit("remote_"), z.cast("string"))) \
            .otherwise(F.concat(F.lit("city_"), (z % 37).cast("string")))


def zip_state(z: Column) -> Column:
    return F.concat(F.lit("S"), (z % 37 % 7).cast("string"))


def _nullif(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    p = F.col("p")
    status = (F.when(k % 10 == 0, "canceled").when(k % 10 == 1, "shipped")
              .when(k % 100 == 2, "unavailable").otherwise("delivered"))
    return (o.select("o_orderkey", "o_custkey", "o_orderdate")
             .withColumn("p", F.timestamp_add("SECOND", k % 86400, F.col("o_orderdate")))
             .select(
                 k.cast("string").alias("order_id"),
                 F.col("o_custkey").cast("string").alias("customer_id"),
                 status.alias("order_status"),
                 p.alias("order_purchase_timestamp"),
                 _nullif(k % 13 == 0, _hours(p, k % 50)).alias("order_approved_at"),
                 _nullif(k % 11 == 0, _hours(p, 20 + k % 150)).alias("order_delivered_carrier_date"),
                 _nullif(k % 9 == 0, _hours(p, 60 + k % 600)).alias("order_delivered_customer_date"),
                 _nullif(k % 17 == 0, _hours(p, 360)).alias("order_estimated_delivery_date"),
             ))


def as_text(df: DataFrame, cols: list[str]) -> DataFrame:
    """Timestamps as the raw CSV has them: text, NULL written as ' ' (even
    order keys) or '' (odd ones)."""
    blank = F.when(F.col("order_id").cast("bigint") % 2 == 0, " ").otherwise("")
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), blank) for c in cols})


def orders_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the raw CSV has them."""
    return as_text(orders(spark, sf_dir), ORDER_TIME_COLS)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    z = k % 200
    return c.select(
        k.cast("string").alias("customer_id"),
        F.concat(F.lit("u"), (k % 1200).cast("string")).alias("customer_unique_id"),
        z.cast("string").alias("customer_zip_code_prefix"),
        zip_city(z).alias("customer_city"),
        zip_state(z).alias("customer_state"),
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _read(spark, sf_dir, "supplier").select("s_suppkey")
    z = F.col("s_suppkey") * 3 % 190
    main = s.select(F.col("s_suppkey").cast("string").alias("seller_id"),
                    z.cast("string").alias("seller_zip_code_prefix"),
                    zip_city(z).alias("seller_city"), zip_state(z).alias("seller_state"))
    c = _read(spark, sf_dir, "customer").select("c_custkey").where(F.col("c_custkey") < 30)
    z2 = 185 + F.col("c_custkey") % 15
    rare = c.select((F.col("c_custkey") + 100000).cast("string").alias("seller_id"),
                    z2.cast("string").alias("seller_zip_code_prefix"),
                    zip_city(z2).alias("seller_city"), zip_state(z2).alias("seller_state"))
    return main.unionByName(rare)


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _read(spark, sf_dir, "events").select("event_id")
    i = F.col("event_id")
    z = i % 180
    return e.select(
        z.cast("string").alias("geolocation_zip_code_prefix"),
        (F.lit(-23.0) + (i % 997) / F.lit(100.0)).alias("geolocation_lat"),
        (F.lit(-46.0) + (i % 991) / F.lit(100.0)).alias("geolocation_lng"),
        zip_city(z).alias("geolocation_city"),
        zip_state(z).alias("geolocation_state"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    # joined and numbered by the text key, so that the mart's joins on it find
    # the items dealt by it and need no second exchange
    li = _read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"), "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_shipdate")
    o = _read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("_order"), "o_custkey")
    k, ln, pk, ck = F.col("order_id").cast("bigint"), F.col("l_linenumber"), F.col("l_partkey"), F.col("o_custkey")
    w = Window.partitionBy("order_id").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_quantity")
    blank_product = (ck % 50 == 1) | (ck % 200 >= 195) | ((k % 9 == 0) & (ln == 1))
    product = (F.when((k % 23 == 0) & (ln == 2), F.lit(None))
               .when(blank_product, (pk - pk % 1680).cast("string"))
               .otherwise(pk.cast("string")))
    seller = F.when((k % 9 == 0) & (ln == 1), (100000 + k % 30).cast("string")) \
              .otherwise(F.col("l_suppkey").cast("string"))
    return (li.join(o, F.col("order_id") == F.col("_order"), "inner")
              .select(
                  "order_id",
                  F.row_number().over(w).cast("bigint").alias("order_item_id"),
                  product.alias("product_id"),
                  seller.alias("seller_id"),
                  F.col("l_shipdate").alias("shipping_limit_date"),
                  F.col("l_extendedprice").alias("price"),
                  F.col("l_quantity").alias("freight_value"),
              ))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_size", "p_retailprice")
    k, size = F.col("p_partkey"), F.col("p_size")
    no_len, no_dim = k % 16 == 0, k % 14 == 0
    return p.select(
        k.cast("string").alias("product_id"),
        _nullif(k % 15 == 0, F.col("p_type")).alias("product_category_name"),
        _nullif(no_len, F.length("p_name").cast("double")).alias("product_name_lenght"),
        _nullif(no_len, (size * 10).cast("double")).alias("product_description_lenght"),
        _nullif(no_dim, F.col("p_retailprice")).alias("product_weight_g"),
        _nullif(no_dim, size.cast("double")).alias("product_length_cm"),
        _nullif(no_dim, (size % 10 + 1).cast("double")).alias("product_height_cm"),
        _nullif(no_dim, (k % 30 + 1).cast("double")).alias("product_width_cm"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice") \
        .where(F.col("o_orderkey") % 29 != 0)
    k = F.col("o_orderkey")
    ptype = F.element_at(F.array(*[F.lit(t) for t in PAYMENT_TYPE_BY_MOD4]), (k % 4 + 1).cast("int"))
    first = o.select(k.cast("string").alias("order_id"),
                     F.lit(1).alias("payment_sequential"), ptype.alias("payment_type"),
                     (1 + k % 6).cast("int").alias("payment_installments"),
                     F.col("o_totalprice").alias("payment_value"))
    second = o.where(k % 7 == 0).select(
        k.cast("string").alias("order_id"), F.lit(2).alias("payment_sequential"),
        F.lit("voucher").alias("payment_type"), F.lit(1).alias("payment_installments"),
        F.lit(10.0).alias("payment_value"))
    return first.unionByName(second)


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    k, ck, d = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    o = o.where((k % 19 != 0) & (ck % 50 != 0) & (ck % 200 < 195))
    first = o.select(
        k.cast("string").alias("order_id"),
        (1 + k % 5).cast("double").alias("review_score"),
        F.lit(None).cast("string").alias("review_comment_title"),
        _nullif(k % 3 == 0, F.lit("text")).alias("review_comment_message"),
        _hours(d, 700 + k % 90).alias("review_creation_date"),
        _nullif(k % 21 == 0, _hours(d, 800 + k % 200)).alias("review_answer_timestamp"),
    )
    second = o.where(k % 37 == 0).select(
        k.cast("string").alias("order_id"), F.lit(5.0).alias("review_score"),
        F.lit(None).cast("string").alias("review_comment_title"),
        F.lit(None).cast("string").alias("review_comment_message"),
        _hours(d, 900).alias("review_creation_date"),
        _hours(d, 950).alias("review_answer_timestamp"),
    )
    return first.unionByName(second)


def category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct categories minus the smallest one, so the foreign-key check
    has a violation to find."""
    p = _read(spark, sf_dir, "part").select("p_type")
    smallest = p.agg(F.min("p_type")).scalar()  # one value
    return (p.where(F.col("p_type") != smallest)
             .select(F.col("p_type").alias("product_category_name")).distinct())


def load(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All marketplace tables of the adapter, lazily."""
    return {
        "orders": orders(spark, sf_dir),
        "customers": customers(spark, sf_dir),
        "order_items": order_items(spark, sf_dir),
        "products": products(spark, sf_dir),
        "sellers": sellers(spark, sf_dir),
        "payments": payments(spark, sf_dir),
        "reviews": reviews(spark, sf_dir),
        "geolocation": geolocation(spark, sf_dir),
        "category_translation": category_translation(spark, sf_dir),
    }


def load_raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The tables as the raw CSVs have them: time columns as text."""
    times = {"orders": ORDER_TIME_COLS, "order_items": ITEM_TIME_COLS, "reviews": REVIEW_TIME_COLS}
    return {n: as_text(t, times[n]) if n in times else t for n, t in load(spark, sf_dir).items()}


def write_raw_csv(spark: SparkSession, sf_dir: str, root: str, names: list[str] | None = None) -> None:
    """The raw tables as folders of CSV files under ``root``, named like the
    public dataset's files."""
    from .readers import DEFAULT_FILES

    for name, table in load_raw(spark, sf_dir).items():
        if names is None or name in names:
            if name == "category_translation":
                table = table.withColumn("product_category_name_english", F.lit(None).cast("string"))
            table.write.option("header", True).option("escape", '"').csv(f"{root}/{DEFAULT_FILES[name]}.csv")
