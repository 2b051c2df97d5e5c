"""Model evaluation (#76-#82): hash folds, balanced weights, L2 logistic
regression with an inner grid search, confusion-matrix metrics.

Folds are a column (hash of the key, T22), so a fold is a filter, never a
driver-side split. The grid's models of all folds are fitted together
(``newton``): one scan per Newton round, whatever their number. Any other
``pyspark.ml`` estimator runs through ``CrossValidator`` on the same folds.
"""

from __future__ import annotations

from pyspark.ml import Estimator
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import hash_fold
from ..plans.session import cut_lineage
from . import newton
from .clean import ID_COLS, TARGET

# The reference's search space and settings.
GRID_C = [0.1, 1.0, 10.0]
N_SPLITS = 5
SEED = 42
PARALLELISM = 4  # concurrent fits submitted by the driver (like CrossValidator's)


def add_folds(df: DataFrame, key: str = "order_id", k: int = N_SPLITS, salt: str = str(SEED),
              col: str = "fold") -> DataFrame:
    """#76: shuffled, unstratified K-fold as a deterministic column."""
    return df.withColumn(col, hash_fold(key, k, salt))


def class_weights(df: DataFrame, label: str = TARGET) -> DataFrame:
    """#77: balanced weights n / (2 * n_c) per class, one row per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))
    total = df.agg(F.count(F.lit(1)).alias("n_total")).scalar()  # one value
    return counts.withColumn("weight", total / (F.lit(2.0) * F.col("n_rows")))


def label_counts(df: DataFrame, *by: str, label: str = TARGET) -> dict[tuple, int]:
    """Rows per (by..., label): one small aggregate, one row per class and fold."""
    return {tuple(r)[:-1]: r["n"] for r in df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n")).collect()}


def with_weights(df: DataFrame, counts: dict[object, int], label: str = TARGET, col: str = "weight") -> DataFrame:
    """Balanced weights n / (2 * n_c) as a literal expression, no join."""
    n, weight = sum(counts.values()), F.lit(None).cast("double")
    for value, n_c in counts.items():
        weight = F.when(F.col(label).eqNullSafe(F.lit(value)), F.lit(n / (2.0 * n_c))).otherwise(weight)
    return df.withColumn(col, weight)


def assemble(df: DataFrame, feature_cols: list[str] | None = None, null_as: float | None = None) -> DataFrame:
    """#12: feature vector = every column but ids and target.

    A NULL feature (e.g. a distance to a seller without coordinates) is an
    error when the result is computed; ``null_as`` sets a value instead (0.0
    is the column mean after z-scoring).
    """
    cols = feature_cols or [c for c in df.columns
                            if c not in set(ID_COLS) | {TARGET, "fold", "inner_fold", "weight"}]
    if null_as is not None:
        df = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(null_as)) for c in cols})
    return VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="error").transform(df)


def _balanced(counts: dict[object, int]) -> dict[int, float]:
    """Weight per label of a training part with so many rows per label."""
    n = sum(counts.values())
    return {int(value): n / (2.0 * n_c) for value, n_c in counts.items() if value is not None}


def _without(rows: dict[tuple, int], *left_out: int | None) -> dict[object, int]:
    """Rows per label where no fold has its value in ``left_out``; ``rows``: by (folds..., label)."""
    out: dict[object, int] = {}
    for (*folds, value), n in rows.items():
        if all(f != x for f, x in zip(folds, left_out)):
            out[value] = out.get(value, 0) + n
    return out


def _size(data: DataFrame, features: str = "features") -> int:
    row = data.select(F.size(newton.as_array(data, features))).first()
    return row[0] if row else 0


def fit(train: DataFrame, C: float, label: str = TARGET, counts: dict[object, int] | None = None) -> newton.LinearModel:
    """One L2 fit with the balanced weights of this training part (T23).
    ``counts``: its rows per label, if known."""
    counts = counts or {k[0]: n for k, n in label_counts(train, label=label).items()}
    return newton.fit_all(train, [newton.Part(C, _balanced(counts))], label, _size(train))[0]


def auc(model, data: DataFrame, label: str = TARGET) -> float:
    """Exact ROC-AUC from probabilities."""
    row = newton.areas(model.transform(data).withColumn("all", F.lit(0)), "all", label=label, score="probability").first()
    return row.auc if row and row.auc is not None else 0.0


def _chosen(models: dict[object, newton.LinearModel], key: Column, features: Column) -> Column:
    """Probability by the model that ``key`` names; NULL if it names none."""
    out = F.lit(None).cast("double")
    for name, m in models.items():
        p = newton.probability(features, F.array(*map(F.lit, m.coefficients)), F.lit(m.intercept))
        out = F.when(key == F.lit(name), p).otherwise(out)
    return out


def _mean_areas(data: DataFrame, models: dict[tuple, newton.LinearModel], label: str) -> list[tuple]:
    """(outer, C, mean area) over the inner folds, each model on the rows of
    its own inner fold that its outer fold does not hold. ``models``: by (outer, inner, C)."""
    inners = {i for _, i, _ in models}
    scored = newton.score_counts(data, models, label, "inner_fold", "fold" if "fold" in data.columns else None)
    found = {r.model: r.auc for r in newton.areas(scored, "model").collect()}
    means: dict[tuple, float] = {}
    for m, (o, _, c) in enumerate(models):
        means[o, c] = means.get((o, c), 0.0) + (found.get(m) or 0.0)
    return [(o, c, a / len(inners)) for (o, c), a in means.items()]


def _best(means: list[tuple], outer: int | None = None) -> float:
    """The C of the largest mean area, the smallest of equal ones (to 9
    digits: sums in another order are the same area)."""
    return max(((round(a, 9), -c) for o, c, a in means if o == outer))[1] * -1


def grid_search(train: DataFrame, grid=GRID_C, k: int = N_SPLITS, label: str = TARGET):
    """#78: inner k-fold over C (another hash salt), score ROC-AUC, refit
    the best on the whole training part. Returns (best model, scores).

    The training part is written once; the k x |grid| models are fitted
    together, a scan per Newton round, and scored in one query.
    """
    train = add_folds(train, k=k, salt="inner", col="inner_fold")
    train = cut_lineage(train.select(label, "inner_fold", newton.as_array(train, "features").alias("features")), True)
    rows, size = label_counts(train, "inner_fold", label=label), _size(train)
    grid = [float(c) for c in grid]
    names = [(None, i, c) for i in range(k) for c in grid]
    parts = [newton.Part(c, _balanced(_without(rows, i)), {"inner_fold": i}) for _, i, c in names]
    models = dict(zip(names, newton.fit_all(train, parts, label, size)))
    means = _mean_areas(train, models, label)
    found = {c: a for _, c, a in means}
    scores = train.sparkSession.createDataFrame([(c, found.get(c, 0.0)) for c in grid], "C double, mean_auc double")
    best = _best([(None, c, found.get(c, 0.0)) for c in grid])
    near = models[None, 0, best]
    return newton.fit_all(train, [newton.Part(best, _balanced(_without(rows, None)))], label, size, start=near)[0], scores


def predict(model, data: DataFrame) -> DataFrame:
    """#79: hard 0/1 labels."""
    return model.transform(data)


def confusion_metrics(pred: DataFrame, label: str = TARGET, prediction: str = "prediction",
                      by: list[str] | None = None) -> DataFrame:
    """#80: accuracy, precision, recall, F1 and the hard-label ROC-AUC
    ((TPR + TNR) / 2, T24) from one confusion-matrix aggregate; zero
    denominators give 0.0."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    aggs = [F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
            F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 1) & (p == 0)).alias("fn")]
    g = pred.groupBy(*by).agg(*aggs) if by else pred.agg(*aggs)

    def ratio(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    tnr = ratio(tn, tn + fp)
    return g.select(*(by or []), "tp", "fp", "tn", "fn",
                    ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
                    precision.alias("precision"), recall.alias("recall"),
                    ratio(2 * precision * recall, precision + recall).alias("f1"),
                    ((recall + tnr) / 2).alias("roc_auc_hard"))


METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc_hard", "roc_auc_score"]


def average_metrics(per_fold: DataFrame) -> DataFrame:
    """#81: mean of each metric over folds, one row."""
    return per_fold.agg(*[F.avg(m).alias(m) for m in METRICS if m in per_fold.columns])


def _joint_folds(data: DataFrame, k: int, grid: list[float], label: str) -> DataFrame:
    """Outer folds -> inner grid search -> predictions of the held-out rows:
    k x k x |grid| models fitted together, scored together, then the k refits."""
    rows, size = label_counts(data, "fold", "inner_fold", label=label), _size(data)
    names = [(o, i, c) for o in range(k) for i in range(k) for c in grid]
    parts = [newton.Part(c, _balanced(_without(rows, o, i)), {"fold": o, "inner_fold": i}) for o, i, c in names]
    tried = dict(zip(names, newton.fit_all(data, parts, label, size)))
    means = _mean_areas(data, tried, label)
    best = [newton.Part(_best([(o, c, dict((x[:2], x[2]) for x in means).get((o, c), 0.0)) for c in grid], o),
                        _balanced(_without(rows, o, None)), {"fold": o}) for o in range(k)]
    models = dict(enumerate(newton.fit_all(data, best, label, size, start=tried[0, 0, best[0].C])))
    return (data.withColumn("probability", _chosen(models, F.col("fold"), newton.as_array(data, "features")))
            .withColumn("prediction", (F.col("probability") > 0.5).cast("double")))


def _estimator_folds(data: DataFrame, k: int, estimator: Estimator, grid: list | None, label: str) -> DataFrame:
    """The same folds for any estimator: ``CrossValidator`` over its parameter
    maps on each outer fold's training part, whose best model predicts."""
    rows, out = label_counts(data, "fold", label=label), None
    evaluator = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC", numBins=0)
    for f in range(k):
        train = with_weights(data.where(F.col("fold") != f), _without(rows, f), label)
        cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid or [{}], evaluator=evaluator, numFolds=k,
                            foldCol="inner_fold", parallelism=PARALLELISM)
        test = predict(cv.fit(train).bestModel, data.where(F.col("fold") == f))
        test = test.select("fold", label, "prediction", newton.as_array(test, "probability")[1].alias("probability"))
        out = test if out is None else out.unionByName(test)
    return out


def cv_folds(table: DataFrame, k: int = N_SPLITS, grid=None, label: str = TARGET, null_as: float | None = None,
             estimator: Estimator | None = None) -> DataFrame:
    """Outer folds -> inner grid search -> predict -> metrics, a row per fold.
    Runs its jobs when called.

    Without ``estimator``: L2 logistic regression over the values of C in
    ``grid``. With one: any classifier of ``pyspark.ml`` (it finds ``features``,
    the label and a balanced ``weight`` column), ``grid`` being its parameter
    maps."""
    data = assemble(add_folds(add_folds(table, k=k), k=k, salt="inner", col="inner_fold"), null_as=null_as)
    # the joint fit reads the features in every round: plain numbers, not vectors to be taken apart
    features = F.col("features") if estimator else newton.as_array(data, "features").alias("features")
    data = cut_lineage(data.select("order_id", label, "fold", "inner_fold", features), codec="zstd")
    said = (_joint_folds(data, k, [float(c) for c in grid or GRID_C], label) if estimator is None
            else _estimator_folds(data, k, estimator, grid, label))
    return fold_metrics(cut_lineage(said.select("fold", label, "prediction", "probability")), label)


def fold_metrics(said: DataFrame, label: str = TARGET) -> DataFrame:
    """The metrics of each fold of (fold, label, prediction, probability)."""
    area = newton.areas(said, "fold", label=label, score="probability").select(
        F.col("fold").alias("of"), F.coalesce("auc", F.lit(0.0)).alias("roc_auc_score"))
    return confusion_metrics(said, label, by=["fold"]).join(area, F.col("fold") == F.col("of")).drop("of")


def run_cv(table: DataFrame, k: int = N_SPLITS, grid=None, label: str = TARGET, null_as: float | None = None,
           estimator: Estimator | None = None) -> DataFrame:
    """#82: the metrics of ``cv_folds`` averaged over the outer folds, one row."""
    return average_metrics(cv_folds(table, k, grid, label, null_as, estimator))
