import datetime as dt

import duckdb
from pyspark.sql import functions as F

from ordermart.functions import exprs


def test_floor_days_negative(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 2, 1), dt.datetime(2020, 1, 3, 0))],
                               "a timestamp_ntz, b timestamp_ntz")
    r = df.select(exprs.floor_days("a", "b").alias("d"), exprs.hours_between("a", "b").alias("h")).first()
    assert r.d == -1 and r.h == -23.0


def test_add_fractional_days(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1), 1.5)], "t timestamp_ntz, d double")
    assert df.select(exprs.add_fractional_days("t", "d").alias("x")).first().x == dt.datetime(2020, 1, 2, 12)


def test_haversine_symmetric_and_known(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0)], "a double, b double, c double, d double")
    r = df.select(exprs.haversine_km("a", "b", "c", "d").alias("x"),
                  exprs.haversine_km("c", "d", "a", "b").alias("y")).first()
    assert abs(r.x - 111.195) < 1e-2 and abs(r.x - r.y) < 1e-12


def test_hash_fold_matches_duckdb(spark):
    ids = [str(i) for i in range(200)]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    got = {r.id: r.f for r in df.select("id", exprs.hash_fold("id", 5).alias("f")).collect()}
    con = duckdb.connect()
    for i in ids[:50]:
        want = con.execute(f"SELECT CAST(('0x' || substr(md5('{i}' || ':42'), 1, 8)) AS BIGINT) % 5").fetchone()[0]
        assert got[i] == want
    assert set(got.values()) == {0, 1, 2, 3, 4}


def test_blank_to_null_then_cast(spark):
    df = spark.createDataFrame([(" ",), ("",), ("2020-01-01 10:00:00",)], "t string")
    out = [r.x for r in df.select(exprs.text_to_timestamp("t").alias("x")).collect()]
    assert out == [None, None, dt.datetime(2020, 1, 1, 10)]


def test_add_days_is_add_fractional_days_of_the_first_known(spark):
    rows = [(dt.datetime(2020, 1, 1), 3.0, 0.5), (dt.datetime(2020, 1, 1), None, 1.23456789), (dt.datetime(2020, 1, 1, 5), -2.0, None), (dt.datetime(2020, 1, 1), None, None)]
    df = spark.createDataFrame(rows, "t timestamp_ntz, w double, f double")
    for r in df.select(exprs.add_days("t", F.col("w"), F.col("f")).alias("a"), exprs.add_fractional_days("t", F.coalesce("w", "f")).alias("b")).collect():
        assert r.a == r.b
