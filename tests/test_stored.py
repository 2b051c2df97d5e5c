"""Bucketed sides, the mergeable zip state, observed metrics and sketches."""

import pytest
from pyspark.sql import functions as F

from ordermart.operators import geo, mart, profile
from ordermart.plans import pipeline

SF = "/root/testdata/sf0.001"


def _rows(df):
    cols = sorted(df.columns)
    return sorted(map(str, (tuple(r) for r in df.select(*cols).collect())))


@pytest.fixture(scope="module")
def sides(spark):
    t = pipeline.tables(spark, SF)
    zg = geo.build_zip_geo(t["geolocation"], t["customers"], t["sellers"])
    s = mart.store_sides(t, zg, buckets=4)
    yield s, zg, t
    s.drop()


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_stored_sides_join_without_an_exchange(sides, no_broadcast):
    stored = sides[0].mart()
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_stored_mart_equals_the_joined_one(sides):
    s, zg, t = sides
    plain = mart.orders_master(t["orders"], t["customers"], t["order_items"], t["products"], t["sellers"], t["payments"],
                               t["reviews"], zg)
    assert _rows(s.mart()) == _rows(plain)


def test_hot_order_is_read_without_buckets(sides, no_broadcast):
    """The shuffled form, which AQE can split, gives the same rows."""
    s = sides[0]
    hot = s.mart(hot_rows=s.largest_order - 1)
    assert "Exchange" in hot._jdf.queryExecution().executedPlan().toString()
    assert _rows(hot) == _rows(s.mart())


def test_rows_without_an_order_are_not_stored(spark, sides):
    _, zg, t = sides
    lost = t["payments"].limit(3).withColumn("order_id", F.lit(None).cast("string"))
    more = mart.store_sides({**t, "payments": t["payments"].unionByName(lost)}, zg, buckets=2)
    assert spark.table(more.tables["payments"][0]).count() == t["payments"].where("order_id IS NOT NULL").count()
    more.drop()


POINTS = "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, geolocation_city string, geolocation_state string"
BUYERS = "customer_zip_code_prefix string, customer_city string, customer_state string"
SHOPS = "seller_zip_code_prefix string, seller_city string, seller_state string"


def _inputs(spark, points, buyers, shops):
    return [spark.createDataFrame(rows, ddl) for rows, ddl in ((points, POINTS), (buyers, BUYERS), (shops, SHOPS))]


def _places(df):
    return {r[0]: tuple(x if not isinstance(x, float) else round(x, 9) for x in r[1:]) for r in df.select(*geo.DIM_COLS).collect()}


def test_batches_of_the_zip_state_equal_the_full_build(spark):
    points = [("1", 1.0, 5.0, "a", "S"), ("1", 3.0, None, "b", None), ("2", None, None, "a", "S"), (None, 9.0, 9.0, "a", "S"),
              ("3", 4.0, 8.0, None, "T"), ("1", 5.0, 1.0, "a", "Z"), ("2", 7.0, 7.0, "c", "S")]
    buyers = [("7", "c", "S"), ("7", "a", "S"), ("8", None, "S"), (None, "a", "S"), ("1", "q", "S"), ("8", "c", None)]
    shops = [("7", "b", "X"), ("9", "a", "S"), ("9", "a", "R"), ("10", "nowhere", None)]
    full = _places(geo.build_zip_geo(*_inputs(spark, points, buyers, shops)))
    assert full["8"][2] == "c" and full["9"][3] == "R" and full["10"][0] is None
    for n in (2, 3):
        for order in (range(n), reversed(range(n))):
            state = None
            for i in order:
                batch = geo.zip_state(*_inputs(spark, points[i::n], buyers[i::n], shops[i::n]))
                state = (state.merge(batch) if state else batch).stored()
            assert _places(state.dimension()) == full


def test_an_empty_batch_changes_nothing(spark):
    state = geo.zip_state(*_inputs(spark, [("1", 1.0, 2.0, "a", "S")], [("2", "a", "S")], []))
    after = state.merge(geo.zip_state(*_inputs(spark, [], [], [])))
    assert _places(after.dimension()) == _places(state.dimension()) == {"1": (1.0, 2.0, "a", "S"), "2": (1.0, 2.0, "a", "S")}
    assert not _places(geo.zip_state(*_inputs(spark, [], [], [])).dimension())


def test_observed_metrics_equal_a_scan_and_take_one_job(spark):
    df = spark.range(1000).repartition(7).select("id", F.when(F.col("id") % 3 == 0, F.col("id")).alias("odd name"), F.lit(None).cast("string").alias("none"))
    spark.sparkContext.setJobGroup("profiled", "")
    table, seen = profile.write_profiled(df, {"largest": F.max("id")})
    spark.sparkContext.setJobGroup("later", "")
    # the repartition's adaptive stage and the write
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("profiled")) <= 2
    assert seen["n_rows"] == 1000 and seen["largest"] == 999
    nulls = {r.column_name: r.n_null for r in profile.observed_nulls(table, seen).collect()}
    assert nulls == {"id": 0, "odd name": 666, "none": 1000}
    empty, seen = profile.write_profiled(df.where("id < 0"))
    assert seen["n_rows"] == 0 and {r.n_null for r in profile.observed_nulls(empty, seen).collect()} == {0}


def test_exact_cardinality_expands_no_row(spark):
    df = spark.range(5000).select((F.col("id") % 7).alias("a"), F.when(F.col("id") % 2 == 0, F.col("id") % 11).alias("b"),
                                  F.lit(None).cast("int").alias("none"))
    out = profile.cardinality_by_column(df, df.columns)
    assert out.first().asDict() == profile.cardinality(df, df.columns).first().asDict() == {"nunique_a": 7, "nunique_b": 11, "nunique_none": 0}
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()


def test_sketches_merge_within_their_error(spark):
    df = spark.range(60_000).select((F.col("id") % 20_011).alias("many"), (F.col("id") % 5).alias("few"),
                                    F.lit(None).cast("string").alias("none"), (F.col("id") % 4).alias("part"))
    cols = ["many", "few", "none", "part"]
    parts = profile.sketch_table(df, cols, "part")
    assert parts.count() == 4
    got = profile.merged_cardinality(parts, cols).first()
    assert abs(got.nunique_many - 20_011) <= 4 * 0.0163 * 20_011 and got.nunique_few == 5 and got.nunique_none == 0 and got.nunique_part == 4
    each = {r.part: r.nunique_many for r in profile.merged_cardinality(parts, cols, "part").collect()}
    assert sum(each.values()) > got.nunique_many  # parts share values: estimates do not add up


def test_larger_tables_take_more_buckets(spark):
    t = pipeline.tables(spark, SF)
    zg = geo.build_zip_geo(t["geolocation"], t["customers"], t["sellers"])
    stored = mart.store_sides(t, zg, buckets=2, bucket_rows=1000)
    n = -(-t["order_items"].count() // 1000)
    assert n > 2 and sum(1 for r in spark.sql(f"DESCRIBE EXTENDED {stored.tables['items'][0]}").collect()
                         if r.col_name == "Num Buckets" and r.data_type == str(n)) == 1
    assert sorted(map(str, stored.mart().collect())) == sorted(map(str, mart.build_mart(t).collect()))
    stored.drop()
