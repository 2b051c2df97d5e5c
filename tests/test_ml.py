"""Jointly fitted models against MLlib and a dense Newton solution; the model hook."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.tuning import ParamGridBuilder

from ordermart.operators import ml, newton


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(1500, 4)), 3)
    p = 1 / (1 + np.exp(-(x @ [1.0, -0.5, 0.0, 0.3] - 0.9)))
    rows = [(f"o{i}", *map(float, x[i]), int(rng.random() < p[i])) for i in range(len(x))]
    return spark.createDataFrame(rows, "order_id string, a double, b double, c double, d double, bad_review int").repartition(3)


@pytest.fixture(scope="module")
def data(table):
    return ml.assemble(ml.add_folds(table)).select("order_id", "bad_review", "fold", "features")


def _dense(x, y, c):
    """Newton on the whole matrix, balanced weights."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    b, ridge = np.zeros(x.shape[1]), np.append(np.ones(x.shape[1] - 1), 0)
    for _ in range(40):
        p = 1 / (1 + np.exp(-x @ b))
        b -= np.linalg.solve(c * (x.T * (w * p * (1 - p))) @ x + np.diag(ridge), c * x.T @ (w * (p - y)) + ridge * b)
    return b


def _matrix(df):
    rows = df.collect()
    return np.array([r.features.toArray() for r in rows]), np.array([r.bad_review for r in rows])


def test_fit_equals_dense_newton_and_mllib(data):
    train = data.where("fold <> 0")
    for c in (0.1, 10.0):
        model = ml.fit(train, c)
        got = np.array([*model.coefficients, model.intercept])
        assert np.allclose(got, _dense(*_matrix(train), c), atol=1e-8)
        counts = {k[0]: n for k, n in ml.label_counts(train).items()}
        lib = LogisticRegression(labelCol="bad_review", weightCol="weight", regParam=1 / (c * sum(counts.values())),
                                 standardization=False, maxIter=5000, tol=1e-12).fit(ml.with_weights(train, counts))
        assert np.allclose(got, [*lib.coefficients, lib.intercept], atol=1e-6)
        ours = {r.order_id: r.prediction for r in ml.predict(model, data).collect()}
        assert ours == {r.order_id: r.prediction for r in lib.transform(data).select("order_id", "prediction").collect()}


def _area(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


def test_areas_with_ties(spark):
    rng = np.random.default_rng(5)
    rows = [(m, float(np.round(rng.random(), 2 + m)) if m else 0.25, int(rng.random() < 0.4)) for m in range(3) for _ in range(400)]
    rows += [(9, 0.5, 1), (9, 0.1, 1)]
    got = {r.m: r.auc for r in newton.areas(spark.createDataFrame(rows, "m int, score double, y int"), "m").collect()}
    for m in range(3):
        y, s = (np.array([r[i] for r in rows if r[0] == m]) for i in (2, 1))
        assert abs(got[m] - _area(y, s)) < 1e-12
    assert got[9] is None


def _search(x, y, inner, grid, k):
    """(best C, mean areas) by dense fits."""
    means = []
    for c in grid:
        total = 0.0
        for i in range(k):
            b = _dense(x[inner != i], y[inner != i], c)
            total += _area(y[inner == i], x[inner == i] @ b[:-1] + b[-1])
        means.append(total / k)
    return grid[int(np.argmax(means))], means


def test_grid_search_and_cv_equal_dense_models(table, data):
    grid, k = [0.001, 0.1, 10.0], 3
    folded = ml.add_folds(ml.add_folds(table, k=k), k=k, salt="inner", col="inner_fold").orderBy("order_id").collect()
    x, y = np.array([[r.a, r.b, r.c, r.d] for r in folded]), np.array([r.bad_review for r in folded])
    fold, inner = (np.array([r[c] for r in folded]) for c in ("fold", "inner_fold"))
    best, means = _search(x, y, inner, grid, k)
    model, scores = ml.grid_search(ml.assemble(table), grid, k)
    assert np.allclose([r.mean_auc for r in scores.orderBy("C").collect()], means, atol=1e-9)
    assert np.allclose([*model.coefficients, model.intercept], _dense(x, y, best), atol=1e-8)
    got = {r.fold: r for r in ml.cv_folds(table, k, grid).collect()}
    for o in range(k):
        train, test = fold != o, fold == o
        best, _ = _search(x[train], y[train], inner[train], grid, k)
        z = x[test] @ (b := _dense(x[train], y[train], best))[:-1] + b[-1]
        assert got[o].tp == ((z > 0) & (y[test] == 1)).sum() and got[o].fp == ((z > 0) & (y[test] == 0)).sum()
        assert abs(got[o].roc_auc_score - _area(y[test], z)) < 1e-9


def test_any_estimator(table):
    tree = DecisionTreeClassifier(labelCol="bad_review", weightCol="weight", seed=1)
    maps = ParamGridBuilder().addGrid(tree.maxDepth, [2, 4]).build()
    rows = ml.cv_folds(table, 3, maps, estimator=tree).collect()
    assert sorted(r.fold for r in rows) == [0, 1, 2] and sum(r.tp + r.fp + r.tn + r.fn for r in rows) == 1500
    assert all(r.roc_auc_score > 0.6 for r in rows)
    n = 1500 * 2 / 3
    lib = LogisticRegression(labelCol="bad_review", weightCol="weight", standardization=False, maxIter=1000, tol=1e-12)
    maps = ParamGridBuilder().addGrid(lib.regParam, [1 / n]).build()
    theirs, ours = (ml.run_cv(table, 3, g, estimator=e).first() for g, e in ((maps, lib), ([1.0], None)))
    assert all(abs(theirs[m] - ours[m]) < 0.01 for m in ml.METRICS)


def test_one_class_and_no_rows(data):
    one = ml.fit(data.where("bad_review = 1"), 1.0)
    assert one.intercept == float("inf") and ml.predict(one, data).where("prediction <> 1").count() == 0
    assert ml.grid_search(data.limit(0))[1].where("mean_auc <> 0").count() == 0


def test_joint_fit_sums_a_hessian_per_row_not_per_model(data, monkeypatch):
    """Models of near optima take one Hessian a row, in the cells; the optima are those of dense Newton steps."""
    curved = []
    sums = newton._sums
    monkeypatch.setattr(newton, "_sums", lambda *a: curved.append(len(a[-1])) or sums(*a))
    rows = ml.label_counts(data, "fold")
    parts = [newton.Part(c, ml._balanced(ml._without(rows, f)), {"fold": f}) for f in range(5) for c in (1.0, 10.0)]
    models = newton.fit_all(data, parts, "bad_review", 4)
    kept = data.collect()
    x, y, fold = (np.array(v) for v in ([r.features.toArray() for r in kept], [r.bad_review for r in kept], [r.fold for r in kept]))
    for part, m in zip(parts, models):
        here = fold != part.without["fold"]
        assert np.allclose([*m.coefficients, m.intercept], _dense(x[here], y[here], part.C), atol=1e-8)
    assert curved and sum(curved) < len(parts)


def test_models_far_from_each_other_get_their_own_hessians(spark):
    """A fold whose labels are turned, and C of ten powers: the common model is near none of them."""
    rng = np.random.default_rng(11)
    x, fold = rng.normal(size=(400, 3)) * [1.0, 5.0, 0.2], np.arange(400) % 2
    y = (rng.random(400) < 1 / (1 + np.exp(-(x @ [2.0, -1.0, 1.0]) * np.where(fold == 0, 1, -1)))).astype(int)
    frame = spark.createDataFrame([([*map(float, r)], int(v), int(f)) for r, v, f in zip(x, y, fold)],
                                  "features array<double>, bad_review int, fold int")
    rows = ml.label_counts(frame, "fold")
    parts = [newton.Part(c, ml._balanced(ml._without(rows, f)), {"fold": f}) for f in range(2) for c in (1e-6, 1.0, 1e4)]
    for part, m in zip(parts, newton.fit_all(frame, parts, "bad_review", 3)):
        here = fold != part.without["fold"]
        assert np.allclose([*m.coefficients, m.intercept], _dense(x[here], y[here], part.C), atol=1e-6)


def test_equal_rows_have_equal_scores(spark):
    rng = np.random.default_rng(2)
    x = [*map(float, rng.normal(size=7))]
    frame = spark.createDataFrame([(x, i % 2, i % 3) for i in range(50)], "features array<double>, y int, inner_fold int").coalesce(1)
    model = newton.LinearModel(tuple(map(float, rng.normal(size=7))), 0.1)
    got = newton.scores(frame, {(None, i, 1.0): model for i in range(3)}, "y", "inner_fold").collect()
    z = 0.1 + sum(a * b for a, b in zip(x, model.coefficients))
    assert len(got) == 50 and len({r.score for r in got}) == 1 and abs(got[0].score - 1 / (1 + np.exp(-z))) < 1e-12
