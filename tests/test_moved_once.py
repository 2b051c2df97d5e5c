"""Rows are moved, looked up and written once, whatever the session's threshold for broadcasts."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from ordermart.operators import encode, fitted, geo, impute, mart, newton, orderlevel
from ordermart.plans import pipeline, session

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    cols = sorted(df.columns)
    return sorted(map(str, (tuple(r) for r in df.select(*cols).collect())))


def _near(got, want):
    assert got.keys() == want.keys()
    for order, row in got.items():
        for c, v in row.asDict().items():
            w = want[order][c]
            assert v == w or (isinstance(v, float) and w is not None and math.isclose(v, w, rel_tol=1e-9, abs_tol=1e-9)), (order, c)


@pytest.fixture
def threshold(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    yield lambda value: spark.conf.set(key, value)
    spark.conf.set(key, before)


def test_items_are_not_dealt_by_seller(spark, threshold):
    """Sellers are broadcast after the joins by order; a seller that comes twice or has no key included."""
    threshold("-1")
    t = pipeline.tables(spark, SF)
    odd = t["sellers"].where("seller_id = '3'").unionByName(t["sellers"].where("seller_id = '5'").withColumn("seller_id", F.lit(None).cast("string")))
    t["sellers"] = t["sellers"].unionByName(odd)
    zg = geo.build_zip_geo(t["geolocation"], t["customers"], t["sellers"])
    sides = [t[n] for n in ("orders", "customers", "order_items", "products", "sellers", "payments", "reviews")]
    few, many = mart.orders_master(*sides, zg), mart.orders_master(*sides, zg, seller_rows=0)
    assert "hashpartitioning(seller_id" not in _plan(few) and "hashpartitioning(seller_id" in _plan(many)
    assert _rows(few) == _rows(many)


def test_items_of_other_orders_are_not_looked_up(spark):
    kept = pipeline.orders_master(spark, SF, "delivered")
    assert "LeftSemi" in _plan(kept)
    assert _rows(kept) == _rows(pipeline.orders_master(spark, SF).where("order_status = 'delivered'"))


def test_written_mart_holds_no_date_twice(spark, monkeypatch):
    m, seen = pipeline.orders_master(spark, SF), []
    monkeypatch.setattr(impute, "cut_bucketed", lambda df, key, codec=None: seen.append(df.columns) or session.cut_bucketed(df, key, codec))
    out = impute.impute_all(m, by_order=True)
    assert not set(impute.DATE_COLS) & set(seen[0])
    assert out.columns == [*m.columns, "has_review_message"] and impute.fill_dates(m.where("seller_id IS NOT NULL")).columns == m.columns


def test_payment_fill_joins_the_mart_once(spark):
    """The modes and the fill read a written mart."""
    assert "Join" not in _plan(impute.fill_payment(pipeline.orders_master(spark, SF)))


def test_deduped_order_level_moves_no_row(spark):
    from ordermart.operators import features

    out = pipeline.order_level(spark, SF, dedupe=True, checkpoint=False)
    assert "Exchange hashpartitioning" not in _plan(out)
    same = orderlevel.order_level(features.add_features(impute.impute_all(pipeline.orders_master(spark, SF))), dedupe=True)
    _near(*[{r.order_id: r for r in d.collect()} for d in (out, same)])


def test_fit_on_train_moves_no_row_by_order(spark, monkeypatch):
    """The mart is written once, dealt by the order: the order level of all rows is aggregated in place."""
    levels = []

    def cut(df, *args, **kwargs):
        if "bad_review" in df.columns:
            levels.append(_plan(df))
        return session.cut_lineage(df, *args, **kwargs)

    monkeypatch.setattr(fitted, "cut_lineage", cut)
    out = E.queries()["fit_on_train"](spark, SF)
    assert len(levels) == 1 and "hashpartitioning(order_id" not in levels[0]
    assert "ObjectHashAggregate" not in _plan(out)


def test_counts_of_known_size_are_broadcast(spark, threshold):
    threshold("100k")
    df = session.cut_lineage(spark.range(200_000).select("id", F.when(F.col("id") % 8 > 0, (F.col("id") % 8).cast("string")).alias("c")))
    out = encode.frequency_encode(df, ["c"])
    assert "SortMergeJoin" not in _plan(out) and "BroadcastHashJoin" in _plan(out)
    assert {(r[0], r[1]) for r in out.groupBy("c_freq").count().collect()} == {(25_000, 175_000), (None, 25_000)}


@pytest.mark.parametrize("query, columns", [("distinct_values", ["payment_type"]), ("frequency_encode", E.O.FREQ_COLS),
                                            ("metrics", ["order_delay_time", "bad_review"])])
def test_only_the_columns_read_are_computed(spark, monkeypatch, query, columns):
    ids = spark.createDataFrame([("a",), ("b",), ("c",)], "order_id string")
    level = ids.withColumns({c: F.lit(1) for c in columns} | {"avg_price": F.raise_error(F.col("order_id")).cast("double")})
    monkeypatch.setattr(pipeline, "featured", lambda spark, sf_dir: ids)
    monkeypatch.setattr(orderlevel, "order_level", lambda df: level)
    assert E.queries()[query](spark, "none").count() >= 1


def test_scores_are_moved_once(spark):
    """Counted scores give the areas of the scores; a NULL label counts for neither side."""
    rng = np.random.default_rng(3)
    rows = [([float(v) for v in np.round(rng.normal(size=2), 1)], [0, 1, None][int(rng.integers(3))], int(i % 2), int(i % 3)) for i in range(600)]
    data = spark.createDataFrame(rows, "features array<double>, y int, inner_fold int, fold int").repartition(3)
    models = {(o, i, 1.0): newton.LinearModel((0.5 + o, -1.0), 0.1 * i) for o in range(3) for i in range(2)}
    args = (models, "y", "inner_fold", "fold")
    once = newton.areas(newton.score_counts(data, *args), "model")
    plan = _plan(once)
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 2
    want = {(r.outer, r.inner): r.auc for r in newton.areas(newton.scores(data, *args), "outer", "inner", "C").collect()}
    got = {list(models)[r.model][:2]: r.auc for r in once.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got)


def test_fills_are_not_in_the_joins_method(spark):
    """The JVM compiles no method above 8000 bytes."""
    key = "spark.sql.adaptive.enabled"
    spark.conf.set(key, "false")
    try:
        plan = pipeline.order_level(spark, SF, checkpoint=False)._jdf.queryExecution().executedPlan()
        debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
        stages = debug.codegenStringSeq(plan)
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    finally:
        spark.conf.set(key, "true")
    assert max(sizes) > 1000 and max(sizes) <= 8000
