"""Cascade semantics against an independent pandas model."""
import random

import numpy as np
import pandas as pd

from ordermart.operators import impute


def pandas_mean_cascade(pdf, col, levels, global_level=False):
    """Sequential reference: each level's mean is over the column as already
    filled; NULL keys never match."""
    x = pdf[col].copy()
    for k in levels:
        means = pd.Series(x.values, index=pdf.index).groupby(pdf[k]).mean()  # NaN keys dropped
        fill = pdf[k].map(means)
        x = x.where(x.notna(), fill)
    if global_level:
        x = x.fillna(x.mean())
    return x


def pandas_stale(pdf, col, levels):
    x = pdf[col].copy()
    mask = x.isna()
    x[mask] = pdf.loc[mask, levels[0]].map(x.groupby(pdf[levels[0]]).mean())
    for k in levels[1:]:
        if x.isna().any():
            x[mask] = pdf.loc[mask, k].map(x.groupby(pdf[k]).mean())
    return x


def _frame(n=400, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        st = rnd.choice(["A", "B", None]) if rnd.random() < 0.97 else None
        city = None if rnd.random() < 0.05 else f"{st}{rnd.randint(0, 4)}"
        cust = None if rnd.random() < 0.05 else f"c{rnd.randint(0, 60)}"
        v = None if rnd.random() < 0.3 else float(rnd.randint(1, 5))
        rows.append((i, cust, city, st, v))
    return rows


def _spark_fill(spark, rows, specs, keys):
    df = spark.createDataFrame(rows, "id long, customer_unique_id string, customer_city string, "
                                     "customer_state string, v double")
    fills = impute.cascade_means(df, keys, specs)
    out = impute._apply_means(impute._null_safe_join(df, fills, keys), ["v"])
    return out.toPandas().set_index("id").sort_index()["v"]


def test_mean_cascade_matches_sequential_pandas(spark):
    rows = _frame()
    keys = ["customer_unique_id", "customer_city", "customer_state"]
    got = _spark_fill(spark, rows, [impute.MeanSpec("v", keys, True)], keys)
    pdf = pd.DataFrame(rows, columns=["id"] + keys + ["v"]).set_index("id")
    want = pandas_mean_cascade(pdf, "v", keys, True)
    assert np.allclose(got.values, want.values, equal_nan=True, atol=1e-12)


def test_cascade_never_changes_non_null(spark):
    rows = _frame(seed=3)
    keys = ["customer_unique_id", "customer_city", "customer_state"]
    got = _spark_fill(spark, rows, [impute.MeanSpec("v", keys)], keys)
    for (i, *_, v) in rows:
        if v is not None:
            assert got[i] == v


def test_stale_mask_matches_pandas(spark):
    keys = ["customer_unique_id", "customer_city", "customer_state"]
    for seed in (1, 2, 5):
        rows = _frame(seed=seed)
        got = _spark_fill(spark, rows, [impute.MeanSpec("v", keys, stale=True)], keys)
        pdf = pd.DataFrame(rows, columns=["id"] + keys + ["v"]).set_index("id")
        want = pandas_stale(pdf, "v", keys)
        assert np.allclose(got.values, want.values, equal_nan=True, atol=1e-12)


def test_stale_mask_overwrites_level_one(spark):
    # c1 has a score, so its NULL row is filled at level 1 (5.0); row 3 has no
    # customer and stays NULL, so the city level overwrites every masked row.
    rows = [(1, "c1", "X", "S", 5.0), (2, "c1", "X", "S", None), (3, None, "X", "S", None),
            (4, "c2", "X", "S", 1.0)]
    keys = ["customer_unique_id", "customer_city", "customer_state"]
    got = _spark_fill(spark, rows, [impute.MeanSpec("v", keys, stale=True)], keys)
    assert got[2] == got[3] == (5.0 + 5.0 + 1.0) / 3
    masked = _spark_fill(spark, rows, [impute.MeanSpec("v", keys)], keys)
    assert masked[2] == 5.0


def test_mode_cascade_ties_and_null_keys(spark):
    rows = [(1, "k1", "b"), (2, "k1", "a"), (3, "k1", None), (4, None, None), (5, "k2", None)]
    df = spark.createDataFrame(rows, "id long, k string, v string")
    fills = impute.mode_fills(df, "v", ["k"])
    out = impute._apply_means(impute._null_safe_join(df, fills, ["k"]), ["v"])
    got = {r.id: r.v for r in out.collect()}
    assert got[3] == "a"          # tie -> smallest value
    assert got[4] is None         # NULL key never matches
    assert got[5] is None         # all-NULL group -> NULL


def test_payment_fill_without_score_one_rows(spark):
    df = spark.createDataFrame([(None, 2.0, 3.0, "boleto", 1, 2, 4.0)],
                               "total_payment double, price double, freight_value double, "
                               "payment_type string, payment_sequential int, payment_installments int, "
                               "review_score double")
    r = impute.fill_payment(df).first()
    assert r.total_payment == 5.0 and r.payment_type is None


def test_review_replies(spark):
    import datetime as dt
    d = dt.datetime(2020, 1, 1)
    df = spark.createDataFrame([("", None, d, None), (None, d, d, d)],
                               "review_comment_message string, review_creation_date timestamp_ntz, "
                               "order_delivered_customer_date timestamp_ntz, review_answer_timestamp timestamp_ntz")
    a, b = impute.fill_review_replies(df).collect()
    assert a.has_review_message == 1 and a.review_creation_date == d
    assert a.review_answer_timestamp == d + dt.timedelta(days=999)
    assert b.has_review_message == 0


def test_level_order_respects_every_spec():
    specs = [impute.MeanSpec("a", ["customer_city", "customer_state"]),
             impute.MeanSpec("b", ["customer_unique_id", "customer_city", "customer_state"])]
    assert impute._level_order(specs) == ["customer_unique_id", "customer_city", "customer_state"]


def test_combined_cascades_equal_separate(spark):
    """impute_all shares one summary for several cascades; each column must
    come out as if run alone."""
    rows = _frame(seed=11)
    keys = ["customer_unique_id", "customer_city", "customer_state"]
    both = [impute.MeanSpec("v", ["customer_city", "customer_state"]),
            impute.MeanSpec("w", keys, stale=True)]
    df = spark.createDataFrame([r + (r[4],) for r in rows],
                               "id long, customer_unique_id string, customer_city string, "
                               "customer_state string, v double, w double")
    fills = impute.cascade_means(df, keys, both)
    out = impute._apply_means(impute._null_safe_join(df, fills, keys), ["v", "w"])
    got = out.toPandas().set_index("id").sort_index()
    pdf = pd.DataFrame(rows, columns=["id"] + keys + ["v"]).set_index("id")
    assert np.allclose(got.v.values, pandas_mean_cascade(pdf, "v", ["customer_city", "customer_state"]).values,
                       equal_nan=True, atol=1e-12)
    assert np.allclose(got.w.values, pandas_stale(pdf, "v", keys).values, equal_nan=True, atol=1e-12)
