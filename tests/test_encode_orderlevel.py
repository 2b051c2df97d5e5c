import datetime as dt

from ordermart.operators import encode, orderlevel, profile, quality


def test_one_hot_drops_first_and_null_is_zero(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "p string")
    out = encode.one_hot(df, ["p"])
    assert out.columns == ["p_b", "p_c"]
    rows = [tuple(r) for r in out.collect()]
    assert rows == [(1, 0), (0, 0), (0, 0), (0, 1)]


def test_frequency_is_count_and_null_stays_null(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, None), (4, "y")], "id int, c string")
    got = {r.id: r.c_freq for r in encode.frequency_encode(df, ["c"]).collect()}
    assert got == {1: 2, 2: 2, 3: None, 4: 1}


def test_zscore_only_more_than_two_distinct(spark):
    df = spark.createDataFrame([(1.0, 0, 1.0), (2.0, 1, 1.0), (3.0, 0, 2.0), (4.0, 1, 2.0)],
                               "x double, y int, w double")
    out = encode.zscore(df, binary={"y"}).toPandas()
    assert abs(out.x.mean()) < 1e-12 and abs(out.x.std() - 1) < 1e-6
    assert list(out.w) == [1.0, 1.0, 2.0, 2.0] and list(out.y) == [0, 1, 0, 1]


def test_label_encode_unmapped_is_null(spark):
    df = spark.createDataFrame([("delivered",), ("unavailable",)], "order_status string")
    assert [r[0] for r in encode.label_encode(df, ["order_status"]).collect()] == [6, None]


def _ol_frame(spark, rows):
    return spark.createDataFrame(rows, orderlevel_schema())


def orderlevel_schema():
    return ("order_id string, order_item_id long, payment_sequential int, review_to_answer_time_h double, "
            "delivery_review_time long, review_score double, customer_unique_id string, product_id string, "
            "product_description_lenght double, product_name_lenght double, customer_city string, "
            "customer_state string, payment_type string, payment_installments int, "
            "order_approval_time_h double, order_delivery_time long, order_delay_time long, "
            "product_category_name string, seller_city string, seller_state string, "
            "product_dimensions double, product_weight_g double, seller_customer_distance double, "
            "price double, freight_value double, seller_delay long")


def test_order_level_first_sum_and_target(spark):
    base = dict(customer_unique_id="u", product_id=None, product_description_lenght=None,
                product_name_lenght=None, customer_city="c", customer_state="s", payment_type=None,
                payment_installments=None, order_approval_time_h=None, order_delivery_time=None,
                order_delay_time=None, product_category_name=None, seller_city="x", seller_state="s",
                product_dimensions=None, product_weight_g=None, seller_customer_distance=None,
                price=None, freight_value=None, seller_delay=None)
    names = [f.split()[0] for f in orderlevel_schema().split(", ")]

    def row(**kw):
        d = dict(base, **kw)
        return tuple(d.get(n) for n in names)

    rows = [row(order_id="o1", order_item_id=2, payment_sequential=1, review_to_answer_time_h=1.0,
                delivery_review_time=0, review_score=5.0, product_id="p2", price=10.0),
            row(order_id="o1", order_item_id=1, payment_sequential=1, review_to_answer_time_h=1.0,
                delivery_review_time=0, review_score=None, product_id="p1", price=20.0),
            row(order_id="o2", order_item_id=None, payment_sequential=None, review_to_answer_time_h=None,
                delivery_review_time=None, review_score=None)]
    out = {r.order_id: r for r in orderlevel.order_level(_ol_frame(spark, rows)).collect()}
    assert out["o1"].product_id == "p1"            # first in row order
    assert out["o1"].bad_review == 0               # first non-null score is 5.0
    assert out["o1"].total_price == 30.0 and out["o1"].count_order_item_id == 2
    assert out["o2"].total_price == 0.0            # sum of nothing is 0.0
    assert out["o2"].bad_review == 0               # missing score is not bad
    assert out["o2"].count_order_item_id == 0


def test_quality_checks(spark):
    p = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    assert sorted((r.key_value, r.n_rows) for r in quality.pk_violations(p, "k").collect()
                  if r.key_value) == [("a", 2)]
    child = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    v = quality.fk_violations(child, "k", p, "k").collect()
    assert [(r.key_value, r.n_rows) for r in v] == [("z", 1)]


def test_correlation_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0, 1.0), (2.0, 5.0, None), (3.0, 5.0, 3.0)], "a double, b double, c double")
    got = {(r.col_a, r.col_b): r.r for r in profile.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert got[("a", "b")] is None and got[("b", "a")] is None
    assert abs(got[("a", "c")] - 1.0) < 1e-12 and abs(got[("a", "a")] - 1.0) < 1e-12
    assert len(got) == 9


def test_rows_missing_tags(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None), (dt.datetime(2020, 1, 1), 2.0)],
                               "order_approved_at timestamp_ntz, review_score double")
    out = profile.rows_missing(df, ["order_approved_at", "review_score"])
    assert sorted(r.missing_column for r in out.collect()) == ["order_approved_at", "order_approved_at",
                                                               "review_score"]


def test_dedupe_keeps_the_least_row_with_a_single_copy(spark):
    rows = [("o", 1, 2, "z", 5.0), ("o", 1, 1, "b", 7.0), ("o", 1, 1, "a", 8.0), ("o", 2, None, "c", 1.0)]
    df = spark.createDataFrame(rows, "order_id string, order_item_id long, payment_sequential int, customer_city string, price double")
    out = orderlevel.dedupe_items(df)
    assert sorted(map(tuple, out.collect())) == [("o", 1, 1, "a", 8.0), ("o", 2, None, "c", 1.0)]
    assert "min_by" not in out._jdf.queryExecution().toString()
