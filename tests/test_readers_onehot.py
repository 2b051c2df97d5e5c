"""The reader binds by name; one-hot coding never loses a value."""

import pytest
from pyspark.sql import functions as F

from ordermart.operators import encode
from ordermart.plans import session
from ordermart.sources import readers
from ordermart.sources.schemas import RAW


def test_reordered_csv_with_extra_column(spark, tmp_path):
    names = [f.name for f in RAW["category_translation"].fields]
    path = tmp_path / "t.csv"
    path.write_text(f'extra,{names[1]},{names[0]}\n1,"two\nlines ""q""",one\n')
    row = readers.read_table(spark, str(path), "category_translation").first()
    assert row[names[0]] == "one" and row[names[1]] == 'two\nlines "q"'
    path.write_text(f"{names[0]}\none\n")
    with pytest.raises(ValueError, match=names[1]):
        readers.read_table(spark, str(path), "category_translation")


def test_files_of_a_folder_bind_by_their_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,z1,c1,t1\n")
    (tmp_path / "b.csv").write_text("seller_zip_code_prefix,seller_id,seller_state,more,seller_city\nz2,s2,t2,x,c2\n")
    (tmp_path / "_log").write_text("no table")
    (tmp_path / "empty.csv").write_text("")
    got = {tuple(r) for r in readers.read_table(spark, str(tmp_path), "sellers").collect()}
    assert got == {("s1", "z1", "c1", "t1"), ("s2", "z2", "c2", "t2")}
    with pytest.raises(ValueError, match="no CSV file"):
        readers.read_table(spark, str(tmp_path / "nothing"), "sellers")
    (tmp_path / "c.csv").write_text("seller_id,seller_id,seller_zip_code_prefix,seller_city,seller_state\n1,2,3,4,5\n")
    with pytest.raises(ValueError, match="twice"):
        readers.read_table(spark, str(tmp_path), "sellers")


def test_bad_lines_are_named_or_set_aside(spark, tmp_path):
    head = "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
    (tmp_path / "a.csv").write_text(head + "o1,1,boleto,2,3.5\no2,1,boleto\no3,one,voucher,1,2.0\n")
    (tmp_path / "b.csv").write_text(head + "o4,,voucher,1,\no5,1,voucher,1,2.0,9\n")
    good, bad = readers.read_quarantined(spark, str(tmp_path), "payments")
    assert {r.order_id: r.payment_value for r in good.collect()} == {"o1": 3.5, "o4": None}
    assert {(r.file[-5:], r.record.split(",")[0], r.reason) for r in bad.collect()} == {
        ("a.csv", "o2", "number of columns"), ("a.csv", "o3", "type of payment_sequential"), ("b.csv", "o5", "number of columns")}
    with pytest.raises(Exception, match="a.csv: number of columns|a.csv: type of|b.csv: number of columns"):
        readers.read_table(spark, str(tmp_path), "payments").collect()


def test_files_are_split_where_no_line_breaks_are_quoted(spark, tmp_path):
    head = "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state\n"
    (tmp_path / "a.csv").write_text(head + "".join(f"{i},1.0,2.0,c,s\n" for i in range(20000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1 << 16)
    try:
        df = readers.read_table(spark, str(tmp_path), "geolocation")
        assert df.count() == 20000 and df.rdd.getNumPartitions() > 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_one_listed_value_is_checked(spark):
    df = spark.createDataFrame([(1, "b")], "id int, x string")
    with pytest.raises(Exception, match="not among the categories"):
        encode.one_hot(df, ["x"], {"x": ["a"]}).collect()


def test_one_hot_unlisted_absent_null(spark):
    df = spark.createDataFrame([(1, "b"), (2, "c"), (3, None)], "id int, x string")
    assert encode.one_hot(df, ["x"]).columns == ["id", "x_c"]
    got = {r.id: r.x_b for r in encode.one_hot(df, ["x"], {"x": ["a", "b", "c"]}).collect()}
    assert got == {1: 1, 2: 0, 3: 0}
    with pytest.raises(Exception, match="not among the categories"):
        encode.one_hot(df, ["x"], {"x": ["a", "b"]}).select(F.sum("x_b")).collect()


def test_released_tables_are_gone(spark):
    owner = session.Scratch(spark)
    df = owner.materialize(spark.range(3))
    assert df.count() == 3
    path = owner.paths[0]
    owner.release()
    with pytest.raises(Exception):
        spark.read.parquet(path)
