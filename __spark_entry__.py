"""

Each registered query runs the library on the fixture adapter built from the
driver's tables (whole tables, no sampling) and returns a DataFrame; its
DuckDB twin in ``oracle_sql`` computes the same rows independently. Both
sides are normalised the same way for the comparison: every numeric column
as DOUBLE rounded to 4 places.
"""

from __future__ import annotations

import importlib.util
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermart.operators import (clean, encode, features, geo, impute, mart, ml, orderlevel,
                                 profile, quality)
from ordermart.plans import oracle as O
from ordermart.plans import pipeline, session
from ordermart.sources import fixtures, readers

SMOKE_DIR = "/root/testdata/sf0.001"

_Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


# ------------------------------------------------------------ normalising
def _norm(df: DataFrame) -> DataFrame:
    """Every numeric column as DOUBLE quantised to 4 places: integer columns
    with NULLs reach pandas as integers from one engine and as floats from
    the other. The quantiser is the same IEEE formula in both engines, with an
    offset that keeps short decimals (averages of prices) off the rounding
    boundary."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.NumericType):
            c = F.floor(c.cast("double") * F.lit(10000.0) + F.lit(O.ROUND_OFFSET)).cast("double") / F.lit(10000.0)
        out.append(c.alias(f.name))
    return df.select(*out)


def _final(ctes: str, select: str) -> str:
    """A complete statement; numeric normalisation is added by ``oracle_sql``."""
    return f"{ctes}\n{select}"


def register(name: str, sql: str | None = None):
    def deco(fn):
        _Q[name] = lambda spark, sf_dir: _norm(fn(spark, sf_dir))
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


# ------------------------------------------------------------ frame types
OL_DOUBLES = ["product_description_length", "product_name_length", "avg_product_dimensions",
              "avg_product_weight_g", "avg_seller_customer_distance", "total_price", "avg_price",
              "avg_freight_value", "order_approval_time_h", "avg_seller_delay"]

CATS = O.CATEGORIES


def _t(spark, sf):
    return fixtures.load(spark, sf)


def _zip_geo(spark, sf):
    t = _t(spark, sf)
    return geo.build_zip_geo(t["geolocation"], t["customers"], t["sellers"])


def _mart(spark, sf):
    return pipeline.orders_master(spark, sf)


def _m0(spark, sf):
    return impute.has_product(impute.delivered_only(pipeline.orders_master(spark, sf, impute.DELIVERED)))


def _ol(spark, sf, columns=None):
    return pipeline.order_level(spark, sf, columns=columns)


M0_SQL = O.with_ctes(O.ADAPTER, O.ZIP_GEO, O.MART,
                               "m0 AS (SELECT * FROM orders_master WHERE order_status = 'delivered' AND product_id IS NOT NULL)")

# ============================================================ 2.1 sources
register("load_tables", O.with_ctes(O.ADAPTER) + """
SELECT 'orders' AS table_name, CAST(count(*) AS BIGINT) AS n_rows FROM raw_orders
UNION ALL SELECT 'customers', count(*) FROM raw_customers
UNION ALL SELECT 'order_items', count(*) FROM raw_order_items
UNION ALL SELECT 'products', count(*) FROM raw_products
UNION ALL SELECT 'sellers', count(*) FROM raw_sellers
UNION ALL SELECT 'payments', count(*) FROM raw_payments
UNION ALL SELECT 'reviews', count(*) FROM raw_reviews
UNION ALL SELECT 'geolocation', count(*) FROM raw_geolocation
UNION ALL SELECT 'category_translation', count(*) FROM raw_category_translation""")(
    lambda spark, sf: _union([t.agg(F.count(F.lit(1)).alias("n_rows"))
                              .select(F.lit(n).alias("table_name"), "n_rows")
                              for n, t in _csv_tables(spark, sf).items()]))


def _csv_tables(spark, sf, names=None):
    """The raw tables written as CSV folders in the shared folder and read back."""
    root = session.scratch(spark).path()
    fixtures.write_raw_csv(spark, sf, root, names)
    if names is None:
        return readers.load_tables(spark, root)
    return {n: readers.read_table(spark, f"{root}/{readers.DEFAULT_FILES[n]}.csv", n) for n in names}


def _union(dfs):
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


register("mart_source", _final(O.BASE, "SELECT * FROM orders_master"))(
    lambda spark, sf: mart.mart_source(spark, _mart(spark, sf)))
register("zip_geo_table", _final(O.with_ctes(O.ADAPTER, O.ZIP_GEO), "SELECT * FROM zip_geo"))(_zip_geo)


@register("append_zips", _final(O.with_ctes(O.ADAPTER, O.ZIP_GEO),
                                "SELECT * FROM zip_geo WHERE geolocation_zip_code_prefix NOT IN "
                                "(SELECT geolocation_zip_code_prefix FROM zg_base)"))
def _append_zips(spark, sf):
    t = _t(spark, sf)
    base = geo.zip_geo_agg(t["geolocation"])
    return _zip_geo(spark, sf).join(base.select(geo.ZIP), geo.ZIP, "left_anti")


@register("mart_view", _final(O.BASE, "SELECT order_status, CAST(count(*) AS BIGINT) AS n_rows, "
                              "count(DISTINCT order_id) AS n_orders FROM orders_master GROUP BY 1"))
def _mart_view(spark, sf):
    mart.register_mart_view(_mart(spark, sf), "orders_master")
    return spark.sql("SELECT order_status, count(*) AS n_rows, count(DISTINCT order_id) AS n_orders "
                     "FROM orders_master GROUP BY order_status")


# The mart as FIXTURES.md states it.
_MART_TYPES = {
    "order_id": "string", "customer_unique_id": "string", "customer_city": "string", "customer_state": "string",
    "customer_lat": "double", "customer_lng": "double", "order_status": "string",
    "order_purchase_timestamp": "timestamp_ntz", "order_approved_at": "timestamp_ntz",
    "order_delivered_carrier_date": "timestamp_ntz", "order_delivered_customer_date": "timestamp_ntz",
    "order_estimated_delivery_date": "timestamp_ntz", "order_item_id": "bigint", "product_id": "string",
    "product_category_name": "string", "product_name_lenght": "double", "product_description_lenght": "double",
    "product_weight_g": "double", "product_length_cm": "double", "product_height_cm": "double",
    "product_width_cm": "double", "seller_id": "string", "seller_city": "string", "seller_state": "string",
    "seller_lat": "double", "seller_lng": "double", "shipping_limit_date": "timestamp_ntz", "price": "double",
    "freight_value": "double", "payment_sequential": "int", "payment_type": "string", "payment_installments": "int",
    "total_payment": "double", "review_score": "double", "review_comment_title": "string",
    "review_comment_message": "string", "review_creation_date": "timestamp_ntz",
    "review_answer_timestamp": "timestamp_ntz"}
# Only the status has no NULL by its definition.
_DESCRIBE_SQL = _final(O.BASE, "SELECT t.*, n.n_rows FROM (VALUES "
                       + ", ".join(f"({i}, '{c}', '{t}', {c != 'order_status'})" for i, (c, t) in enumerate(_MART_TYPES.items()))
                       + ") AS t(position, column_name, data_type, nullable), "
                       "(SELECT count(*) AS n_rows FROM orders_master) AS n")


@register("describe_frame", _DESCRIBE_SQL)
def _describe(spark, sf):
    return profile.describe_frame(_mart(spark, sf))


register("preview", _final(O.BASE, "SELECT * FROM orders_master ORDER BY "
                           + ", ".join(f"{c} NULLS LAST" for c in mart.MART_COLS) + " LIMIT 5"))(
    lambda spark, sf: profile.preview(_mart(spark, sf)))

# ============================================================ 2.2 cleaning
_TEXT_COLS = ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
              "order_delivered_customer_date", "order_estimated_delivery_date"]
register("blank_to_null", O.with_ctes(O.ADAPTER) + "\nSELECT order_id, " + ", ".join(
    f"CASE WHEN trim({c}) = '' THEN NULL ELSE {c} END AS {c}" for c in _TEXT_COLS)
    + " FROM raw_orders_text")(
    lambda spark, sf: clean.blank_to_null(fixtures.orders_text(spark, sf)).select("order_id", *_TEXT_COLS))
register("text_to_timestamp", O.with_ctes(O.ADAPTER) + "\nSELECT order_id, " + ", ".join(
    f"CAST(CASE WHEN trim({c}) = '' THEN NULL ELSE {c} END AS TIMESTAMP) AS {c}" for c in _TEXT_COLS)
    + " FROM raw_orders_text")(
    lambda spark, sf: clean.clean_orders(fixtures.orders_text(spark, sf)).select("order_id", *_TEXT_COLS))
register("text_to_timestamp_items", O.with_ctes(O.ADAPTER) + """
SELECT order_id, order_item_id, shipping_limit_date FROM raw_order_items""")(
    lambda spark, sf: clean.clean_items(_csv_tables(spark, sf, ["order_items"])["order_items"])
    .select("order_id", "order_item_id", "shipping_limit_date"))
register("text_to_timestamp_reviews", O.with_ctes(O.ADAPTER) + """
SELECT order_id, review_score, review_creation_date, review_answer_timestamp FROM raw_reviews""")(
    lambda spark, sf: clean.clean_reviews(_csv_tables(spark, sf, ["reviews"])["reviews"])
    .select("order_id", "review_score", "review_creation_date", "review_answer_timestamp"))
register("drop_geo_cols", O.with_ctes(O.ADAPTER)
         + "\nSELECT * EXCLUDE (customer_city, customer_state) FROM raw_customers")(
    lambda spark, sf: clean.drop_geo_cols(_t(spark, sf)["customers"], "customer"))
register("mart_projection", _final(O.BASE, "SELECT order_id, customer_unique_id, customer_city, "
                                   "customer_state, customer_lat, customer_lng, seller_id, seller_city, "
                                   "seller_state, seller_lat, seller_lng, total_payment FROM orders_master"))(
    lambda spark, sf: _mart(spark, sf).select(
        "order_id", "customer_unique_id", "customer_city", "customer_state", "customer_lat",
        "customer_lng", "seller_id", "seller_city", "seller_state", "seller_lat", "seller_lng",
        "total_payment"))

# ============================================================ 2.3 integrity
register("pk_check", O.with_ctes(O.ADAPTER, O.ZIP_GEO) + """
SELECT 'products' AS table_name, product_id AS key_value, count(*) AS n_rows FROM raw_products
  GROUP BY 2 HAVING count(*) > 1 OR product_id IS NULL
UNION ALL SELECT 'category_translation', product_category_name, count(*) FROM raw_category_translation
  GROUP BY 2 HAVING count(*) > 1 OR product_category_name IS NULL
UNION ALL SELECT 'zip_geo', geolocation_zip_code_prefix, count(*) FROM zip_geo
  GROUP BY 2 HAVING count(*) > 1 OR geolocation_zip_code_prefix IS NULL""")(
    lambda spark, sf: quality.pk_report({
        "products": (_t(spark, sf)["products"], "product_id"),
        "category_translation": (_t(spark, sf)["category_translation"], "product_category_name"),
        "zip_geo": (_zip_geo(spark, sf), geo.ZIP)}))


def _fk_sql(child: str, ck: str, parent: str, pk: str, blocks=(O.ADAPTER,)) -> str:
    return O.with_ctes(*blocks) + (
        f"\nSELECT {ck} AS key_value, count(*) AS n_rows FROM {child} WHERE {ck} IS NOT NULL "
        f"AND {ck} NOT IN (SELECT {pk} FROM {parent} WHERE {pk} IS NOT NULL) GROUP BY 1")


register("fk_payments_orders", _fk_sql("raw_payments", "order_id", "raw_orders", "order_id"))(
    lambda spark, sf: quality.fk_violations(_t(spark, sf)["payments"], "order_id",
                                            _t(spark, sf)["orders"], "order_id"))
register("fk_items_products", _fk_sql("raw_order_items", "product_id", "raw_products", "product_id"))(
    lambda spark, sf: quality.fk_violations(_t(spark, sf)["order_items"], "product_id",
                                            _t(spark, sf)["products"], "product_id"))
register("fk_products_translation", _fk_sql("raw_products", "product_category_name",
                                             "raw_category_translation", "product_category_name"))(
    lambda spark, sf: quality.fk_violations(_t(spark, sf)["products"], "product_category_name",
                                            _t(spark, sf)["category_translation"], "product_category_name"))
register("fk_customers_zip", _fk_sql("raw_customers", "customer_zip_code_prefix", "zip_geo",
                                     "geolocation_zip_code_prefix", (O.ADAPTER, O.ZIP_GEO)))(
    lambda spark, sf: quality.fk_violations(_t(spark, sf)["customers"], "customer_zip_code_prefix",
                                            _zip_geo(spark, sf), geo.ZIP))
register("fk_sellers_zip", _fk_sql("raw_sellers", "seller_zip_code_prefix", "zip_geo",
                                   "geolocation_zip_code_prefix", (O.ADAPTER, O.ZIP_GEO)))(
    lambda spark, sf: quality.fk_violations(_t(spark, sf)["sellers"], "seller_zip_code_prefix",
                                            _zip_geo(spark, sf), geo.ZIP))

# ============================================================ 2.4 profiling
register("zip_duplicates", O.with_ctes(O.ADAPTER) + """
SELECT sum(n) AS total_rows, count(zip) AS unique_values, sum(n) - count(zip) AS duplicates_count
FROM (SELECT geolocation_zip_code_prefix AS zip, count(*) AS n FROM raw_geolocation GROUP BY zip)""")(
    lambda spark, sf: profile.zip_duplicates(_t(spark, sf)["geolocation"]))


def _orphans_sql(entity: str, who: str) -> str:
    return O.with_ctes(O.ADAPTER) + (f"\nSELECT count(*) AS n_rows FROM {entity} ANTI JOIN raw_geolocation "
                                     f"ON {who}_zip_code_prefix = geolocation_zip_code_prefix")


register("orphan_customers", _orphans_sql("raw_customers", "customer"))(
    lambda spark, sf: profile.orphan_count(_t(spark, sf)["customers"], "customer_zip_code_prefix",
                                           _t(spark, sf)["geolocation"]))
register("orphan_sellers", _orphans_sql("raw_sellers", "seller"))(
    lambda spark, sf: profile.orphan_count(_t(spark, sf)["sellers"], "seller_zip_code_prefix",
                                           _t(spark, sf)["geolocation"]))
register("top_zips", O.with_ctes(O.ADAPTER, O.ZIP_GEO) + """
SELECT geolocation_zip_code_prefix FROM zg_base ORDER BY geolocation_zip_code_prefix DESC NULLS FIRST LIMIT 20""")(
    lambda spark, sf: profile.top_zips(geo.zip_geo_agg(_t(spark, sf)["geolocation"])))

_MART_COLS = mart.MART_COLS
register("null_counts", O.BASE + "\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_null FROM orders_master"
    for c in _MART_COLS))(lambda spark, sf: profile.null_counts(_mart(spark, sf)))
register("null_counts_observed", _SQL["null_counts"])(
    lambda spark, sf: profile.observed_nulls(*profile.write_profiled(_mart(spark, sf))))
register("rows_missing", _final(O.BASE, "\nUNION ALL ".join(
    f"SELECT '{c}' AS missing_column, * FROM orders_master WHERE {c} IS NULL"
    for c in ("order_approved_at", "order_delivered_customer_date", "customer_lat", "product_category_name",
              "product_weight_g", "review_score", "total_payment", "product_name_lenght", "product_description_lenght"))))(
    lambda spark, sf: profile.rows_missing(_mart(spark, sf)))
register("status_rows", _final(O.BASE, "SELECT * FROM orders_master WHERE order_status IN ('canceled', 'unavailable')"))(
    lambda spark, sf: clean.status_rows(_mart(spark, sf)))

_CARD = ["most_common_product_category_name", "payment_type", "customer_state", "customer_city",
         "most_common_seller_state", "most_common_seller_city", "product_name_length",
         "product_description_length"]
register("cardinality", O.ORDER_LEVEL_SQL + "\nSELECT " + ", ".join(
    f"count(DISTINCT {c}) AS nunique_{c}" for c in _CARD) + " FROM order_level")(
    lambda spark, sf: profile.cardinality(_ol(spark, sf), _CARD))
register("cardinality_by_column", _SQL["cardinality"])(
    lambda spark, sf: profile.cardinality_by_column(_ol(spark, sf), _CARD))
register("cardinality_sketches", O.ORDER_LEVEL_SQL + "".join(
    f"\n{'UNION ALL ' if i else ''}SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_exact, true AS within_4_errors FROM order_level"
    for i, c in enumerate(_CARD)))(lambda spark, sf: _sketched(spark, sf))


def _sketched(spark, sf):
    """Sketches kept per state, merged over all: the estimate stays within four standard errors of the exact count."""
    ol = _ol(spark, sf)
    parts = session.cut_lineage(profile.sketch_table(ol, _CARD, "customer_state"))
    counted = [d.unpivot([], d.columns, "column_name", n) for d, n in (
        (profile.merged_cardinality(parts, _CARD), "n_sketch"), (profile.cardinality_by_column(ol, _CARD), "n_exact"))]
    error = F.lit(4 * 1.04 / 2 ** (profile.SKETCH_LOG / 2))
    return counted[0].join(counted[1], "column_name").select(
        F.substring("column_name", len("nunique_") + 1, 100).alias("column_name"), "n_exact",
        (F.abs(F.col("n_sketch") - F.col("n_exact")) <= F.ceil(error * F.col("n_exact"))).alias("within_4_errors"))


register("distinct_values", O.ORDER_LEVEL_SQL + "\nSELECT DISTINCT payment_type FROM order_level")(
    lambda spark, sf: profile.distinct_values(_ol(spark, sf, ["payment_type"]), "payment_type"))
register("target_distribution", O.ORDER_LEVEL_SQL
         + "\nSELECT bad_review, count(*) AS n_rows FROM order_level GROUP BY 1")(
    lambda spark, sf: profile.target_distribution(_ol(spark, sf)))

_CORR = OL_DOUBLES + ["count_order_item_id", "nunique_product_category_name", "payment_installments",
                      "order_delivery_time", "order_delay_time", "bad_review"]


def _corr_sql() -> str:
    pairs = [(a, b) for i, a in enumerate(_CORR) for b in _CORR[i:]]
    sel = []
    for a, b in pairs:
        r = (f"(SELECT CASE WHEN isnan(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))) THEN NULL "
             f"ELSE corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) END FROM order_level)")
        sel.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {r} AS r")
        if a != b:
            sel.append(f"SELECT '{b}' AS col_a, '{a}' AS col_b, {r} AS r")
    return _final(O.ORDER_LEVEL_SQL, "\nUNION ALL ".join(sel))


register("correlation_matrix", _corr_sql())(
    lambda spark, sf: profile.correlation_matrix(_ol(spark, sf), _CORR))

# ============================================================ 2.5 geo
register("zip_geo_agg", _final(O.with_ctes(O.ADAPTER, O.ZIP_GEO), "SELECT * FROM zg_base"))(
    lambda spark, sf: geo.zip_geo_agg(_t(spark, sf)["geolocation"]))
register("zip_geo_add_customers", _final(O.with_ctes(O.ADAPTER, O.ZIP_GEO),
                                         "SELECT * FROM zg_c WHERE geolocation_zip_code_prefix NOT IN "
                                         "(SELECT geolocation_zip_code_prefix FROM zg_base)"))(
    lambda spark, sf: geo.add_missing_zips(geo.zip_geo_agg(_t(spark, sf)["geolocation"]),
                                           _t(spark, sf)["customers"], "customer_zip_code_prefix",
                                           "customer_city", "customer_state")
    .join(geo.zip_geo_agg(_t(spark, sf)["geolocation"]).select(geo.ZIP), geo.ZIP, "left_anti"))
register("zip_geo_add_sellers", _final(O.with_ctes(O.ADAPTER, O.ZIP_GEO),
                                       "SELECT * FROM zip_geo WHERE geolocation_zip_code_prefix NOT IN "
                                       "(SELECT geolocation_zip_code_prefix FROM zg_c)"))(
    lambda spark, sf: _append_zips(spark, sf).join(
        _t(spark, sf)["customers"].select(F.col("customer_zip_code_prefix").alias(geo.ZIP)).distinct(),
        geo.ZIP, "left_anti"))

def _zip_batches(spark, sf, n: int = 3):
    """All points, customers and sellers in batches by zip-independent hashes, each merged into the stored state."""
    t = _t(spark, sf)
    parts = {"geolocation": F.xxhash64("geolocation_lat", "geolocation_lng"), "customers": F.xxhash64("customer_id"),
             "sellers": F.xxhash64("seller_id")}
    state = None
    for i in range(n):
        batch = geo.zip_state(*[t[name].where(F.pmod(h, F.lit(n)) == i) for name, h in parts.items()])
        state = (state.merge(batch) if state else batch).stored()
    return state.dimension()


register("zip_geo_batches", _final(O.with_ctes(O.ADAPTER, O.ZIP_GEO), "SELECT * FROM zip_geo"))(_zip_batches)

# ============================================================ 2.6 joins
_ITEM_KEYS = ("order_id", "order_item_id")

register("join_customers", O.with_ctes(O.ADAPTER) + """
SELECT order_id, customer_unique_id, customer_zip_code_prefix FROM raw_orders LEFT JOIN raw_customers USING (customer_id)""")(
    lambda spark, sf: mart.with_customers(_t(spark, sf)["orders"], _t(spark, sf)["customers"])
    .select("order_id", "customer_unique_id", "customer_zip_code_prefix"))
register("join_items", O.with_ctes(O.ADAPTER) + """
SELECT order_id, order_item_id, product_id, seller_id, price FROM raw_orders LEFT JOIN raw_order_items USING (order_id)""")(
    lambda spark, sf: mart.with_items(_t(spark, sf)["orders"], _t(spark, sf)["order_items"])
    .select(*_ITEM_KEYS, "product_id", "seller_id", "price"))
register("join_products", O.with_ctes(O.ADAPTER) + """
SELECT order_id, order_item_id, good.product_id, product_category_name, product_weight_g
FROM raw_order_items AS line LEFT JOIN raw_products AS good ON good.product_id = line.product_id""")(
    lambda spark, sf: mart.with_products(_t(spark, sf)["order_items"], _t(spark, sf)["products"])
    .select(*_ITEM_KEYS, "product_id", "product_category_name", "product_weight_g"))
register("join_sellers", O.with_ctes(O.ADAPTER) + """
SELECT order_id, order_item_id, shop.seller_id, seller_zip_code_prefix
FROM raw_order_items AS line LEFT JOIN raw_sellers AS shop ON shop.seller_id = line.seller_id""")(
    lambda spark, sf: mart.with_sellers(_t(spark, sf)["order_items"], _t(spark, sf)["sellers"])
    .select(*_ITEM_KEYS, "seller_id", "seller_zip_code_prefix"))
register("join_payments", O.with_ctes(O.ADAPTER) + """
SELECT order_id, payment_sequential, payment_type, payment_value AS total_payment
FROM raw_orders LEFT JOIN raw_payments USING (order_id)""")(
    lambda spark, sf: mart.with_payments(_t(spark, sf)["orders"], _t(spark, sf)["payments"])
    .select("order_id", "payment_sequential", "payment_type", "total_payment"))
register("join_reviews", O.with_ctes(O.ADAPTER) + """
SELECT order_id, review_score, review_creation_date FROM raw_orders LEFT JOIN raw_reviews USING (order_id)""")(
    lambda spark, sf: mart.with_reviews(_t(spark, sf)["orders"], _t(spark, sf)["reviews"])
    .select("order_id", "review_score", "review_creation_date"))


def _placed_sql(entity: str, who: str) -> str:
    return O.with_ctes(O.ADAPTER, O.ZIP_GEO) + f"""
SELECT {who}_id, place.city AS {who}_city, place.geo_state AS {who}_state, place.lat AS {who}_lat, place.lng AS {who}_lng
FROM {entity} LEFT JOIN zip_geo AS place ON place.geolocation_zip_code_prefix = {who}_zip_code_prefix"""


register("join_customer_geo", _placed_sql("raw_customers", "customer"))(
    lambda spark, sf: mart.with_geo(_t(spark, sf)["customers"].select("customer_id", "customer_zip_code_prefix"),
                                    "customer_zip_code_prefix", _zip_geo(spark, sf), "customer"))
register("join_seller_geo", _placed_sql("raw_sellers", "seller"))(
    lambda spark, sf: mart.with_geo(_t(spark, sf)["sellers"].select("seller_id", "seller_zip_code_prefix"),
                                    "seller_zip_code_prefix", _zip_geo(spark, sf), "seller"))
register("orders_master", _final(O.BASE, "SELECT * FROM orders_master"))(_mart)
register("orders_master_stored", _final(O.BASE, "SELECT * FROM orders_master"))(
    lambda spark, sf: mart.build_mart_stored(_t(spark, sf), buckets=8))


@register("lookup_map", M0_SQL + """
SELECT order_id, order_item_id, seller_id,
       CASE WHEN seller_id IS NOT NULL THEN avg(price) OVER (PARTITION BY seller_id) END AS seller_mean_price
FROM m0""")
def _lookup(spark, sf):
    m0 = _m0(spark, sf).select("order_id", "order_item_id", "seller_id", "price")
    return mart.lookup_map(m0, "seller_id", mart.group_mean(m0, "seller_id", "price"), "seller_id",
                           "_mean_price", "seller_mean_price").drop("price")

# ============================================================ 2.7 filters
register("delivered_only", _final(O.BASE, "SELECT * FROM orders_master WHERE order_status = 'delivered'"))(
    lambda spark, sf: impute.delivered_only(_mart(spark, sf)))
register("has_product", _final(M0_SQL, "SELECT * FROM m0"))(_m0)

# ============================================================ 2.8 imputation


def _single(*blocks: str) -> str:
    return O.with_ctes(O.ADAPTER, O.ZIP_GEO, O.MART,
                       "m0 AS (SELECT * FROM orders_master WHERE order_status = 'delivered' AND product_id IS NOT NULL)",
                       *blocks)


_C = ["customer_lat", "customer_lng"]
register("fill_coords", _final(_single(O.mean_level("m0", "a1", _C, "customer_city"),
                                       O.mean_level("a1", "a2", _C, "customer_state")),
                               "SELECT * FROM a2"))(
    lambda spark, sf: impute.fill_coords(_m0(spark, sf)))
_DAYS = ", ".join(f"floor(date_diff('microsecond', order_purchase_timestamp, {c}) / 86400000000.0) AS {d}"
                  for c, d in zip(O.DATES, O.DAYS))
_REDATE = ", ".join(f"order_purchase_timestamp + to_microseconds(CAST(round({d} * 86400000000.0) AS BIGINT)) AS {c}"
                    for c, d in zip(O.DATES, O.DAYS))
register("fill_dates", _final(_single(f"b0 AS (SELECT *, {_DAYS} FROM m0)",
                                      O.mean_level("b0", "b1", O.DAYS, "seller_id"),
                                      O.mean_level("b1", "b2", O.DAYS, "seller_city"),
                                      O.mean_level("b2", "b3", O.DAYS, "seller_state"),
                                      O.mean_level("b3", "b4", O.DAYS, None),
                                      f"b5 AS (SELECT * EXCLUDE ({', '.join(O.DAYS)}) REPLACE ({_REDATE}) FROM b4)"),
                              "SELECT * FROM b5"))(
    lambda spark, sf: impute.fill_dates(_m0(spark, sf)))
register("fill_category", _final(_single(O.mode_level("m0", "c1", "product_category_name", "customer_unique_id"),
                                         O.mode_level("c1", "c2", "product_category_name", "seller_id"),
                                         O.mode_level("c2", "c3", "product_category_name", "seller_city"),
                                         O.mode_level("c3", "c4", "product_category_name", "seller_state")),
                                 "SELECT * FROM c4"))(
    lambda spark, sf: impute.fill_category(_m0(spark, sf)))
register("fill_product_info", _final(_single(O.mean_level("m0", "p1", O.PINFO, "seller_id"),
                                             O.mean_level("p1", "p2", O.PINFO, "seller_city"),
                                             O.mean_level("p2", "p3", O.PINFO, "seller_state"),
                                             O.mean_level("p3", "p4", O.PINFO, None)),
                                     "SELECT * FROM p4"))(
    lambda spark, sf: impute.fill_product_info(_m0(spark, sf)))
register("fill_dimensions", _final(_single(O.mean_level("m0", "x1", O.DIMS, "customer_unique_id"),
                                           O.mean_level("x1", "x2", O.DIMS, "customer_city"),
                                           O.mean_level("x2", "x3", O.DIMS, "customer_state")),
                                   "SELECT * FROM x3"))(
    lambda spark, sf: impute.fill_dimensions(_m0(spark, sf)))


def _gm(col):
    return (f"(SELECT {col} FROM m0 WHERE review_score = 1.0 AND {col} IS NOT NULL "
            f"GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)")


register("fill_payment", _final(_single(
    f"pm AS (SELECT {_gm('payment_type')} AS pt, {_gm('payment_sequential')} AS ps, {_gm('payment_installments')} AS pi)",
    "y1 AS (SELECT m0.* REPLACE ("
    "CASE WHEN m0.total_payment IS NULL THEN m0.freight_value + m0.price ELSE m0.total_payment END AS total_payment, "
    "CASE WHEN m0.total_payment IS NULL THEN pm.pt ELSE m0.payment_type END AS payment_type, "
    "CASE WHEN m0.total_payment IS NULL THEN pm.ps ELSE m0.payment_sequential END AS payment_sequential, "
    "CASE WHEN m0.total_payment IS NULL THEN pm.pi ELSE m0.payment_installments END AS payment_installments"
    ") FROM m0 CROSS JOIN pm)"), "SELECT * FROM y1"))(
    lambda spark, sf: impute.fill_payment(_m0(spark, sf)))
register("fill_review", _final(_single(
    "r1 AS (SELECT *, review_score IS NULL AS rmask, CASE WHEN review_score IS NULL THEN "
    "(CASE WHEN customer_unique_id IS NOT NULL THEN avg(review_score) OVER (PARTITION BY customer_unique_id) END) "
    "ELSE review_score END AS rs1 FROM m0)",
    "r2 AS (SELECT *, CASE WHEN rmask AND (SELECT bool_or(rs1 IS NULL) FROM r1) THEN "
    "(CASE WHEN customer_city IS NOT NULL THEN avg(rs1) OVER (PARTITION BY customer_city) END) "
    "ELSE rs1 END AS rs2 FROM r1)",
    "r3 AS (SELECT *, CASE WHEN rmask AND (SELECT bool_or(rs2 IS NULL) FROM r2) THEN "
    "(CASE WHEN customer_state IS NOT NULL THEN avg(rs2) OVER (PARTITION BY customer_state) END) "
    "ELSE rs2 END AS rs3 FROM r2)"),
    "SELECT * EXCLUDE (rmask, rs1, rs2, rs3) REPLACE (rs3 AS review_score) FROM r3"))(
    lambda spark, sf: impute.fill_review(_m0(spark, sf)))
register("fill_review_masked", _final(_single(O.mean_level("m0", "q1", ["review_score"], "customer_unique_id"),
                                              O.mean_level("q1", "q2", ["review_score"], "customer_city"),
                                              O.mean_level("q2", "q3", ["review_score"], "customer_state")),
                                      "SELECT * FROM q3"))(
    lambda spark, sf: impute.fill_review(_m0(spark, sf), masked=True))
register("fill_review_replies", _final(_single(), """SELECT * REPLACE (
  CASE WHEN review_answer_timestamp IS NULL THEN order_delivered_customer_date ELSE review_creation_date END AS review_creation_date,
  CASE WHEN review_answer_timestamp IS NULL THEN order_delivered_customer_date + to_days(999) ELSE review_answer_timestamp END AS review_answer_timestamp),
  CAST(review_comment_message IS NOT NULL AS INTEGER) AS has_review_message FROM m0"""))(
    lambda spark, sf: impute.fill_review_replies(_m0(spark, sf)))
register("impute_all", _final(O.IMPUTED, "SELECT * FROM imputed"))(
    lambda spark, sf: pipeline.imputed(spark, sf))

# ============================================================ 2.9 features
_FEAT_ON_MART = O.with_ctes(O.ADAPTER, O.ZIP_GEO, O.MART, O.features_cte("orders_master", "fm", None))


def _feature_query(name: str):
    sql = _final(_FEAT_ON_MART, f"SELECT order_id, order_item_id, payment_sequential, {name} FROM fm")

    def fn(spark, sf):
        m = _mart(spark, sf)
        return m.select("order_id", "order_item_id", "payment_sequential",
                        features.feature_exprs()[name].alias(name))
    register(name, sql)(fn)


_FEATURES = ["order_approval_time_h", "order_delivery_time", "order_delay_time", "product_dimensions",
             "seller_delay", "seller_customer_distance", "delivery_review_time", "review_to_answer_time_h"]
for _n in _FEATURES:
    _feature_query(_n)

register("add_features", _final(O.FEATURED, "SELECT * FROM featured"))(
    lambda spark, sf: pipeline.featured(spark, sf))
register("drop_raw_cols", O.with_ctes(O.ADAPTER, O.ZIP_GEO, O.MART, O.features_cte("orders_master", "fm", "kept"))
         + "\nSELECT * FROM kept")(
    lambda spark, sf: clean.drop_raw_cols(features.add_features(_mart(spark, sf), drop_raw=False)))

# ============================================================ 2.10 order level
_RAW_OL = O.with_ctes(O.ADAPTER, O.ZIP_GEO, O.MART, O.features_cte("orders_master", "fm", None),
                      O.order_level_cte("fm", "rol", with_msg=False))


def _raw_ol(spark, sf):
    return orderlevel.order_level(features.add_features(_mart(spark, sf), drop_raw=False))


def _agg_query(name: str, cols: list[str]):
    register(name, _final(_RAW_OL, f"SELECT order_id, {', '.join(cols)} FROM rol"))(
        lambda spark, sf: _raw_ol(spark, sf).select("order_id", *cols))


_agg_query("agg_count", ["count_order_item_id"])
_agg_query("agg_first", list(orderlevel.FIRST)[:-1])
_agg_query("agg_nunique", ["nunique_product_category_name"])
_agg_query("agg_mode", list(orderlevel.MODE))
_agg_query("agg_mean", list(orderlevel.MEAN))
_agg_query("agg_sum", ["total_price"])
_agg_query("bad_review", ["bad_review"])
register("order_level", _final(O.ORDER_LEVEL_SQL, "SELECT * FROM order_level"))(_ol)
# all columns of the featured mart, by name
_ROW_SQL = ", ".join(f"{c} NULLS FIRST" for c in sorted((set(_MART_COLS) | set(_FEATURES) | {"has_review_message"})
                                                         - set(O.RAW_DROP)))
register("order_level_dedupe", O.with_ctes(
    O.ADAPTER, O.ZIP_GEO, O.MART, O.impute_ctes(), O.FEATURES,
    "dd AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_id, order_item_id "
    f"ORDER BY {O.order_key(True)}, {_ROW_SQL}) AS rn FROM featured) WHERE rn = 1)",
    O.order_level_cte("dd", "dol")) + "\nSELECT * FROM dol")(
    lambda spark, sf: pipeline.order_level(spark, sf, dedupe=True))

# ============================================================ 2.11 encoding
_STATUS_CASE = ("CASE order_status WHEN 'delivered' THEN 6 WHEN 'shipped' THEN 5 WHEN 'canceled' THEN 4 "
                "WHEN 'invoiced' THEN 3 WHEN 'processing' THEN 2 WHEN 'approved' THEN 1 WHEN 'created' THEN 0 END")
register("label_encode", _final(O.BASE, f"SELECT DISTINCT order_id, {_STATUS_CASE} AS order_status "
                                "FROM orders_master"))(
    lambda spark, sf: encode.label_encode(_mart(spark, sf).select("order_id", "order_status").distinct(),
                                          ["order_status"]))
_DUMMY_SQL = ", ".join(f"CAST(coalesce({c} = '{v}', false) AS INTEGER) AS {c}_{v}"
                       for c in O.ONE_HOT_COLS for v in CATS[c][1:])
register("one_hot", _final(O.ORDER_LEVEL_SQL, f"SELECT order_id, {_DUMMY_SQL} FROM order_level"))(
    lambda spark, sf: encode.one_hot(_ol(spark, sf).select("order_id", *O.ONE_HOT_COLS), O.ONE_HOT_COLS))
register("frequency_encode", O.ORDER_LEVEL_SQL + "\nSELECT o.order_id, " + ", ".join(
    f"f{i}.n AS {c}_freq" for i, c in enumerate(O.FREQ_COLS)) + " FROM order_level o " + " ".join(
    f"LEFT JOIN (SELECT {c} AS v, count(*) AS n FROM order_level WHERE {c} IS NOT NULL GROUP BY 1) f{i} "
    f"ON o.{c} = f{i}.v" for i, c in enumerate(O.FREQ_COLS)))(
    lambda spark, sf: encode.frequency_encode(_ol(spark, sf, ["order_id", *O.FREQ_COLS]), O.FREQ_COLS))
_Z = [c for c in O.SCALED if not c.endswith("_freq")]
register("zscore", _final(
    O.with_ctes(O.ADAPTER, O.ZIP_GEO, O.MART, O.impute_ctes(), O.FEATURES, O.ORDER_LEVEL,
                "zst AS (SELECT " + ", ".join(f"avg({c}) AS mu_{c}, stddev_samp({c}) AS sd_{c}, "
                                              f"count(DISTINCT {c}) AS nd_{c}" for c in _Z) + " FROM order_level)"),
    "SELECT o.order_id, o.bad_review, " + ", ".join(
        f"CASE WHEN zst.nd_{c} > 2 THEN (CAST(o.{c} AS DOUBLE) - zst.mu_{c}) / (zst.sd_{c} + 1e-10) "
        f"ELSE CAST(o.{c} AS DOUBLE) END AS {c}" for c in _Z) + " FROM order_level o CROSS JOIN zst"))(
    lambda spark, sf: encode.zscore(_ol(spark, sf).select("order_id", "bad_review", *_Z), binary={"bad_review"}))
register("feature_table", _final(O.FEATURE_TABLE_SQL, "SELECT * FROM feature_table"))(
    lambda spark, sf: pipeline.feature_table(spark, sf))
register("drop_ids_target", _final(O.FEATURE_TABLE_SQL, "SELECT * EXCLUDE (order_id, customer_unique_id, "
                                   "product_id, bad_review) FROM feature_table"))(
    lambda spark, sf: clean.drop_ids_target(pipeline.feature_table(spark, sf)))

# ============================================================ 2.12 model
register("kfold", O.ORDER_LEVEL_SQL + f"\nSELECT order_id, {O.fold_sql('order_id')} AS fold FROM order_level")(
    lambda spark, sf: ml.add_folds(_ol(spark, sf)).select("order_id", "fold"))
register("class_weight", _final(O.ORDER_LEVEL_SQL, "SELECT bad_review, count(*) AS n_rows, "
                                "(SELECT count(*) FROM order_level) / (2.0 * count(*)) AS weight "
                                "FROM order_level GROUP BY 1"))(
    lambda spark, sf: ml.class_weights(_ol(spark, sf, ["bad_review"])))

# A fixed prediction rule (late delivery -> bad review) makes the metrics
# checkable against SQL; the fitted model path is ``run_cv``.
_RULE_SQL = O.ORDER_LEVEL_SQL + f""",
pr AS (SELECT {O.fold_sql('order_id')} AS fold, bad_review AS y,
  CASE WHEN order_delay_time > 0 THEN 1 ELSE 0 END AS p FROM order_level),
cm AS (SELECT fold, count(*) FILTER (WHERE y = 1 AND p = 1) AS tp, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp,
  count(*) FILTER (WHERE y = 0 AND p = 0) AS tn, count(*) FILTER (WHERE y = 1 AND p = 0) AS fn FROM pr GROUP BY 1),
mt AS (SELECT fold, tp, fp, tn, fn,
  CASE WHEN tp + tn + fp + fn > 0 THEN (tp + tn) / (tp + tn + fp + fn) ELSE 0.0 END AS accuracy,
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
  CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0.0 END AS tnr FROM cm),
mf AS (SELECT fold, tp, fp, tn, fn, accuracy, precision, recall,
  CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1,
  (recall + tnr) / 2 AS roc_auc_hard FROM mt)"""
_M = ["accuracy", "precision", "recall", "f1", "roc_auc_hard"]


def _rule_pred(spark, sf):
    ol = ml.add_folds(_ol(spark, sf, ["order_id", "order_delay_time", "bad_review"]))
    return ol.withColumn("prediction", (F.col("order_delay_time") > 0).cast("int"))


register("metrics", _final(_RULE_SQL, "SELECT * FROM mf"))(
    lambda spark, sf: ml.confusion_metrics(_rule_pred(spark, sf), by=["fold"]))
register("avg_metrics", _final(_RULE_SQL, "SELECT " + ", ".join(f"avg({m}) AS {m}" for m in _M) + " FROM mf"))(
    lambda spark, sf: ml.average_metrics(ml.confusion_metrics(_rule_pred(spark, sf), by=["fold"])))


def _ft(spark, sf):
    return pipeline.feature_table(spark, sf)


# The same models in SQL: fitted by another iteration to the same optimum.
_RECURSIVE = O.FEATURE_TABLE_SQL.replace("WITH ", "WITH RECURSIVE ", 1)
_GRID = "(VALUES " + ", ".join(f"({c})" for c in ml.GRID_C) + ") g(c)"
_SEARCH_SQL = _RECURSIVE + "," + O.logistic_ctes(
    f"SELECT row_number() OVER () AS m, c, 0 AS o, i FROM range({ml.N_SPLITS}) f(i), {_GRID}") + """,
scored AS (SELECT m, y, list_dot_product(x, b) AS s FROM models JOIN betas USING (m) JOIN xs ON fold <> o AND inn = i)"""


@register("grid_search", _SEARCH_SQL + f"""
SELECT c AS "C", avg(auc) AS mean_auc FROM ({O.areas_sql('scored', 'm')}) JOIN models USING (m) GROUP BY c""")
def _grid(spark, sf):
    data = ml.assemble(ml.add_folds(_ft(spark, sf)), null_as=0.0)
    _, scores = ml.grid_search(data.where(F.col("fold") != 0).drop("fold"))
    return scores


@register("predict", _RECURSIVE + "," + O.logistic_ctes("SELECT 1 AS m, 1.0 AS c, 0 AS o, CAST(NULL AS BIGINT) AS i") + """
SELECT order_id, y AS bad_review, CAST(list_dot_product(x, b) > 0 AS INTEGER) AS prediction FROM xs, betas WHERE fold = 0""")
def _predict(spark, sf):
    data = ml.assemble(ml.add_folds(_ft(spark, sf)), null_as=0.0)
    model = ml.fit(data.where(F.col("fold") != 0), 1.0)
    return ml.predict(model, data.where(F.col("fold") == 0)).select(
        "order_id", "bad_review", F.col("prediction").cast("int").alias("prediction"))


def _cv_sql(models_and_xs: str) -> str:
    """Inner search, refit and averaged metrics over (models, xs, betas)."""
    return models_and_xs + f""",
scored AS (SELECT m, y, list_dot_product(x, b) AS s FROM models JOIN betas USING (m) JOIN xs ON fold <> o AND inn = i AND (fs IS NULL OR fs = o)
           WHERE i IS NOT NULL),
means AS (SELECT o, c, avg(auc) AS auc FROM ({O.areas_sql('scored', 'm')}) JOIN models USING (m) GROUP BY o, c),
best AS (SELECT o, first(c ORDER BY round(auc, 9) DESC, c) AS c FROM means GROUP BY o),
said AS (SELECT fold, y, list_dot_product(x, b) AS s FROM best JOIN models USING (o, c) JOIN betas USING (m) JOIN xs ON fold = o AND (fs IS NULL OR fs = o)
         WHERE i IS NULL),
cm AS (SELECT fold, count(*) FILTER (y = 1 AND s > 0) AS tp, count(*) FILTER (y = 0 AND s > 0) AS fp,
              count(*) FILTER (y = 0 AND s <= 0) AS tn, count(*) FILTER (y = 1 AND s <= 0) AS fn FROM said GROUP BY fold),
mt AS (SELECT fold, (tp + tn) / (tp + tn + fp + fn) AS accuracy, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
              CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall, CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0.0 END AS tnr
       FROM cm),
hard AS (SELECT fold, accuracy, precision, recall, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
              ELSE 0.0 END AS f1, (recall + tnr) / 2 AS roc_auc_hard FROM mt),
soft AS ({O.areas_sql('said', 'fold')})
SELECT {', '.join(f'avg({m}) AS {m}' for m in ml.METRICS[:-1])}, avg(coalesce(auc, 0.0)) AS roc_auc_score FROM hard LEFT JOIN soft USING (fold)"""


_CV_MODELS = (f"SELECT row_number() OVER () AS m, c, o, i FROM (SELECT o, i FROM range({ml.N_SPLITS}) a(o), range({ml.N_SPLITS}) b(i) "
              f"UNION ALL SELECT o, NULL FROM range({ml.N_SPLITS}) a(o)), {_GRID}")
register("run_cv", _cv_sql(_RECURSIVE + "," + O.logistic_ctes(_CV_MODELS)))(
    lambda spark, sf: ml.run_cv(_ft(spark, sf), null_as=0.0))


# Imputation, coding and scaling learned without the held-out fold.
register("fit_on_train", O.BASE + ",\n" + O.trained_ctes("(SELECT 0 AS o)") + "\nSELECT * EXCLUDE (o, fold), fold = 0 AS held_out FROM trained")(
    lambda spark, sf: pipeline.fit_on_train(pipeline.orders_master(spark, sf, impute.DELIVERED), by_order=True))

register("run_cv_fit_on_train", _cv_sql(O.BASE.replace("WITH ", "WITH RECURSIVE ", 1) + ",\n" + O.trained_ctes(f"range({ml.N_SPLITS}) folds(o)")
                                        + "," + O.logistic_ctes(_CV_MODELS, table="trained", own="o")))(
    lambda spark, sf: pipeline.cv_fit_on_train(pipeline.orders_master(spark, sf, impute.DELIVERED), by_order=True))


# ============================================================ contract
def _with_scratch(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        session.use_local_scratch(spark)
        return fn(spark, sf_dir)
    return run


def _training_data():
    """The queries of the training-data subpackage, if it is there."""
    if importlib.util.find_spec("ordermart.llm") is None or importlib.util.find_spec("corpus_pipeline") is None:
        return None
    from ordermart.llm import queries as training_data
    return training_data


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the model-ready feature table (#75) on sf0.001."""
    session.use_local_scratch(spark)
    return pipeline.feature_table(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    more = _training_data()
    return {k: _with_scratch(f) for k, f in (_Q | (more.queries() if more else {})).items()}


def oracle_sql() -> dict[str, str]:
    """DuckDB twins. Those of the library's own operators are wrapped so that
    numeric columns become DOUBLE rounded to 4 places, like ``_norm`` on the
    Spark side."""
    more = _training_data()
    return O.normalized(_SQL) | (more.oracle_sql() if more else {})
