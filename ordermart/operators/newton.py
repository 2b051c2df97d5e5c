"""L2 logistic regressions fitted together (#78, #79, #82).

Many models over the same rows -- the folds and regularizations of a grid
search -- take their weighted Newton steps together: one scan per round gives
sums over every model's own rows, so 75 models cost the passes of one. Near a
common model a row adds to one Hessian, that of its cell of label and folds;
from there on to a gradient per model. A task holds one sum per cell (1 + d +
d * d numbers, d bounded by the feature columns) or model; sums merge in Spark,
and the driver solves one d x d system per model.

The objective is C * sum of w * log-loss + |b|^2 / 2, the intercept free.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROUNDS = 60
TOL = 1e-9
#: Parts of the score range whose rows are ranked by themselves.
SCORE_PARTS = 1024


@dataclass(frozen=True)
class Part:
    """One model of a joint fit: rows where a fold column has its value in
    ``without`` are left out; the others weigh by their label."""
    C: float
    weights: dict[int, float]
    without: dict[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class LinearModel:
    """Coefficients and intercept; ``transform`` adds ``probability`` (of
    label 1) and the hard 0/1 ``prediction``."""
    coefficients: tuple[float, ...]
    intercept: float

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        p = probability(as_array(df, features), F.array(*map(F.lit, self.coefficients)), F.lit(self.intercept))
        return df.withColumn("probability", p).withColumn("prediction", (F.col("probability") > 0.5).cast("double"))


def as_array(df: DataFrame, features: str) -> Column:
    return F.col(features) if df.schema[features].dataType.typeName() == "array" else vector_to_array(features)


def probability(x: Column, coefficients: Column, intercept: Column) -> Column:
    """1 / (1 + exp(-z)); NULL where a feature is NULL."""
    z = F.aggregate(F.zip_with(x, coefficients, lambda a, b: a * b), intercept, lambda a, b: a + b)
    return 1.0 / (1.0 + F.exp(-z))


def _added(data: DataFrame, label: str, folds: list[str], n: int, width: int, batch_sums) -> np.ndarray:
    """``n`` sums of ``width`` numbers over all rows: ``batch_sums(x, y, folds)``
    of each batch, added per task and then by Spark."""
    with_one, _ = _helpers()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, width))
        for batch in batches:
            if batch.num_rows:
                y = batch.column("y").to_numpy(zero_copy_only=False)
                total += batch_sums(with_one(batch), y, {c: batch.column(c).to_numpy(zero_copy_only=False) for c in folds})
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(n), pa.int32()),
             pa.ListArray.from_arrays(np.arange(0, total.size + 1, width, np.int32), pa.array(total.ravel()))],
            names=["model", "sums"])

    rows = (data.select(as_array(data, "features").alias("x"), F.col(label).cast("int").alias("y"), *folds)
            .mapInArrow(run, "model int, sums array<double>")
            .groupBy("model").agg(Summarizer.sum(array_to_vector("sums")).alias("sums")).collect())
    out = np.zeros((n, width))
    for r in rows:
        out[r.model] = r.sums.toArray()
    return out


def _helpers():
    """Functions for tasks, pickled whole, so that a worker needs no library of ours."""

    def with_one(batch: pa.RecordBatch) -> np.ndarray:
        """The batch's feature rows with a last column of ones."""
        values = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        return np.hstack([values, np.ones((batch.num_rows, 1))])

    def probability_and_loss(z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        e = np.exp(-np.abs(z))
        return np.where(z >= 0, 1.0, e) / (1 + e), np.maximum(z, 0) + np.log1p(e) - y * z

    return with_one, probability_and_loss


@dataclass(frozen=True)
class _Cells:
    """The rows by label and by the values of the fold columns that some part
    leaves out (one more for all other values): each part is a weighted sum of cells."""
    labels: list[int]
    folds: dict[str, list]

    @classmethod
    def of(cls, parts: list[Part]) -> _Cells:
        return cls(sorted({v for p in parts for v in p.weights}),
                   {c: sorted({p.without[c] for p in parts if c in p.without}) for c in sorted({c for p in parts for c in p.without})})

    def names(self) -> list[tuple]:
        return list(itertools.product(self.labels, *[[*values, None] for values in self.folds.values()]))

    def index(self):
        """A function (for tasks) that gives the cell of each row, one past the
        last for a label without weight."""
        labels, folds, n = self.labels, self.folds, len(self.names())

        def of_rows(y: np.ndarray, of: dict[str, np.ndarray]) -> np.ndarray:
            at = np.full(len(y), len(labels))
            for i, value in enumerate(labels):
                at[y == value] = i
            unknown = at == len(labels)
            for c, values in folds.items():
                fold = np.full(len(y), len(values))
                for i, value in enumerate(values):
                    fold[of[c] == value] = i
                at = at * (len(values) + 1) + fold
            at[unknown] = n
            return at

        return of_rows

    def weights(self, parts: list[Part]) -> np.ndarray:
        """Weight of each cell (and of rows outside them, 0) in each part."""
        def weight(name: tuple, part: Part) -> float:
            out = any(c in part.without and part.without[c] == v for c, v in zip(self.folds, name[1:]))
            return 0.0 if out else part.weights.get(name[0], 0.0)

        return np.array([[weight(name, p) for p in parts] for name in self.names()] + [[0.0] * len(parts)])


def _cell_sums(data: DataFrame, label: str, cells: _Cells, beta: np.ndarray) -> np.ndarray:
    """Per cell: loss, gradient and Hessian of the log-loss of one model, in one
    scan in which every row adds to one Hessian."""
    d, n, index = len(beta), len(cells.names()), cells.index()
    _, probability_and_loss = _helpers()

    def batch_sums(x: np.ndarray, y: np.ndarray, of: dict[str, np.ndarray]) -> np.ndarray:
        out, at = np.zeros((n, 1 + d + d * d)), index(y, of)
        p, loss = probability_and_loss(x @ beta, y)
        for m in np.unique(at[at < n]):
            here = at == m
            r, q = x[here], p[here]
            out[m, 0] = loss[here].sum()
            out[m, 1:1 + d] = (q - y[here]) @ r
            out[m, 1 + d:] = ((r * (q * (1 - q))[:, None]).T @ r).ravel()
        return out

    return _added(data, label, list(cells.folds), n, 1 + d + d * d, batch_sums)


def _sums(data: DataFrame, label: str, parts: list[Part], betas: np.ndarray, curved: list[int]) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Per model loss and gradient of the weighted log-loss, in one scan, and the
    Hessians of the models ``curved``."""
    d, cells = betas.shape[1], _Cells.of(parts)
    weights, size, index, k = cells.weights(parts), 1 + betas.shape[1], cells.index(), len(parts)
    _, probability_and_loss = _helpers()
    # a Hessian is d more rows of sums
    n = len(parts) + len(curved) * d

    def batch_sums(x: np.ndarray, y: np.ndarray, of: dict[str, np.ndarray]) -> np.ndarray:
        out, w = np.zeros((n, size)), weights[index(y, of)]
        p, loss = probability_and_loss(x @ betas.T, y[:, None])
        out[:k, 0] = np.where(w > 0, w * loss, 0.0).sum(axis=0)
        out[:k, 1:] = np.where(w > 0, w * (p - y[:, None]), 0.0).T @ x
        for i, m in enumerate(curved):
            out[k + i * d:k + (i + 1) * d, 1:] = (x * (w[:, m] * p[:, m] * (1 - p[:, m]))[:, None]).T @ x
        return out

    out = _added(data, label, list(cells.folds), n, size, batch_sums)
    return out[:k], {m: out[k + i * d:k + (i + 1) * d, 1:] for i, m in enumerate(curved)}


def _solved(hessian: np.ndarray, gradient: np.ndarray, beta: np.ndarray, c: float) -> np.ndarray:
    """The step of the penalized objective."""
    d = len(beta)
    ridge = np.append(np.ones(d - 1), 0.0)
    return np.linalg.solve(c * hessian + np.diag(ridge) + 1e-14 * np.eye(d), c * gradient + ridge * beta)


def _objective(loss: float, beta: np.ndarray, c: float) -> float:
    return c * loss + 0.5 * (beta[:-1] ** 2).sum()


#: A step of the model fitted first below which the parts' own models take over.
NEAR = 1e-3
#: A model whose step is more than this share of the one before gets its own Hessian.
SHRINK = 0.1


def fit_all(data: DataFrame, parts: list[Part], label: str, n_features: int, rounds: int = ROUNDS,
            tol: float = TOL, start: LinearModel | None = None) -> list[LinearModel]:
    """The parts' models; ``data`` has ``features``, the label and the parts'
    fold columns and is read once per round.

    One model of the parts' mean weights is brought near its optimum first (from
    ``start``, if there is one), by sums per cell of label and folds. Its last
    sums give every part its exact loss, gradient and Hessian there, so a part
    begins with a Newton step of its own. Later rounds sum gradients only: a
    model keeps its Hessian while its steps shrink, and has it summed anew where
    they don't. A model leaves the rounds when its step is below ``tol``; a step
    that does not lower the objective is halved. A part of one class has no
    finite optimum: its intercept is infinite and says that class; one without
    rows says 0.5."""
    d = n_features + 1
    betas = np.zeros((len(parts), d))
    for m, part in enumerate(parts):
        if len(part.weights) < 2:
            betas[m, -1] = np.inf if 1 in part.weights else -np.inf if 0 in part.weights else 0.0
    live = [m for m, part in enumerate(parts) if len(part.weights) == 2]
    if not live:
        return [LinearModel(tuple(map(float, b[:-1])), float(b[-1])) for b in betas]

    cells = _Cells.of([parts[m] for m in live])
    share = cells.weights([parts[m] for m in live])[:-1]
    middle, pooled = float(np.median([parts[m].C for m in live])), share.mean(axis=1)
    beta, last, kept, sums = np.zeros(d), np.inf, None, None
    if start is not None and np.isfinite(start.intercept):
        beta = np.array([*start.coefficients, start.intercept])
    for _ in range(rounds):
        found = _cell_sums(data, label, cells, beta)
        s = pooled @ found
        loss = _objective(s[0], beta, middle)
        if loss > last * (1 + 1e-12) + 1e-12:
            beta = (kept + beta) / 2
            continue
        last, kept, sums = loss, beta.copy(), found
        step = _solved(s[1 + d:].reshape(d, d), s[1:1 + d], beta, middle)
        if start is not None or np.abs(step).max() <= NEAR * (1 + np.abs(beta).max()):
            break
        beta = beta - step

    best, before, hessians, sizes = {}, {}, {}, {}
    for m, s in zip(live, share.T @ sums):
        best[m], before[m], hessians[m] = _objective(s[0], kept, parts[m].C), kept.copy(), s[1 + d:].reshape(d, d)
        step = _solved(hessians[m], s[1:1 + d], kept, parts[m].C)
        betas[m], sizes[m] = kept - step, np.abs(step).max()
    live = [m for m in live if sizes[m] > tol * (1 + np.abs(before[m]).max())]
    slow: set[int] = set()
    for _ in range(rounds):
        if not live:
            break
        sums, own = _sums(data, label, [parts[m] for m in live], betas[live], [i for i, m in enumerate(live) if m in slow])
        still = []
        for i, (m, s) in enumerate(zip(live, sums)):
            b, c = betas[m], parts[m].C
            loss = _objective(s[0], b, c)
            if loss > best[m] * (1 + 1e-12) + 1e-12:
                betas[m] = (before[m] + b) / 2
                slow.add(m)
                still.append(m)
                continue
            best[m], before[m] = loss, b.copy()
            hessians[m] = own.get(i, hessians[m])
            step = _solved(hessians[m], s[1:], b, c)
            betas[m], size = b - step, np.abs(step).max()
            if size > SHRINK * sizes[m]:
                slow.add(m)
            sizes[m] = size
            if size > tol * (1 + np.abs(b).max()):
                still.append(m)
        live = still
    return [LinearModel(tuple(map(float, b[:-1])), float(b[-1])) for b in betas]


def _scored_rows(models: dict[tuple, LinearModel], by: str, without: str | None):
    """A function (for tasks): of each model ``(outer, inner, C)`` that has rows in
    a batch its number, its name, those rows and their scores. A row's sum is
    taken column by column, so equal rows have equal scores."""
    named = [(k, m.coefficients, m.intercept) for k, m in models.items()]

    def of_batch(x: np.ndarray, of: dict[str, np.ndarray]) -> Iterator[tuple[int, tuple, np.ndarray, np.ndarray]]:
        for number, (name, coefficients, intercept) in enumerate(named):
            outer, inner, _ = name
            here = of[by] == inner
            if without and outer is not None:
                here &= of[without] != outer
            rows = np.flatnonzero(here)
            if not len(rows):
                continue
            z = np.full(len(rows), intercept)
            for j, b in enumerate(coefficients):
                z += x[rows, j] * b
            with np.errstate(over="ignore"):
                yield number, name, rows, 1.0 / (1.0 + np.exp(-z))

    return of_batch


def _with_models(data: DataFrame, label: str, folds: list[str], out, schema: str) -> DataFrame:
    """``out(x, y, folds)`` of every batch: rows of ``schema``."""
    with_one, _ = _helpers()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from out(with_one(batch), batch.column("y"),
                               {c: batch.column(c).to_numpy(zero_copy_only=False) for c in folds})

    return (data.select(as_array(data, "features").alias("x"), F.col(label).cast("int").alias("y"), *folds)
            .mapInArrow(run, schema))


def scores(data: DataFrame, models: dict[tuple, LinearModel], label: str, by: str, without: str | None = None) -> DataFrame:
    """(y, inner, outer, C, score) of many models ``(outer, inner, C)``: each on
    the rows whose ``by`` is its inner value and whose ``without`` is not its
    outer one."""
    scored_rows = _scored_rows(models, by, without)

    def out(x: np.ndarray, y: pa.Array, of: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for _, (outer, inner, c), rows, score in scored_rows(x, of):
            n = len(rows)
            yield pa.RecordBatch.from_arrays(
                [y.take(pa.array(rows)), pa.array(np.full(n, inner, np.int32)),
                 pa.nulls(n, pa.int32()) if outer is None else pa.array(np.full(n, outer, np.int32)),
                 pa.array(np.full(n, c)), pa.array(score)], names=["y", "inner", "outer", "C", "score"])

    return _with_models(data, label, [by] + ([without] if without else []), out, "y int, inner int, outer int, C double, score double")


def score_counts(data: DataFrame, models: dict[tuple, LinearModel], label: str, by: str, without: str | None = None) -> DataFrame:
    """(model, s, pos, neg): ``scores`` with the model's place in ``models``, the
    rows of equal scores in a batch counted as one."""
    scored_rows = _scored_rows(models, by, without)

    def out(x: np.ndarray, y: pa.Array, of: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        # a label that is neither counts for none
        labels = y.fill_null(-1).to_numpy(zero_copy_only=False)
        for number, _, rows, score in scored_rows(x, of):
            values, at = np.unique(score, return_inverse=True)
            n, of_rows = len(values), labels[rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, number, np.int32)), pa.array(values),
                 *[pa.array(np.bincount(at[of_rows == v], minlength=n).astype(np.int64)) for v in (1, 0)]],
                names=["model", "s", "pos", "neg"])

    return _with_models(data, label, [by] + ([without] if without else []), out, "model int, s double, pos bigint, neg bigint")


def counted(scored: DataFrame, *by: str, label: str, score: str) -> DataFrame:
    """(by..., s, pos, neg): the rows of each label per score, those of equal
    scores in a batch as one row."""
    names = [*by, "s"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sums = pa.Table.from_batches([batch]).group_by(names).aggregate([("pos", "sum"), ("neg", "sum")])
                yield from sums.select([*names, "pos_sum", "neg_sum"]).rename_columns([*names, "pos", "neg"]).to_batches()

    y = F.col(label).cast("int")
    rows = scored.select(*by, F.col(score).cast("double").alias("s"),
                         *[F.coalesce((y == v).cast("bigint"), F.lit(0)).cast("bigint").alias(n) for n, v in (("pos", 1), ("neg", 0))])
    return rows.mapInArrow(run, rows.schema)


def areas(scored: DataFrame, *by: str, label: str = "y", score: str = "score") -> DataFrame:
    """(by..., auc): exact ROC areas of many models, ties at half. ``scored``: a
    row per label and score, or ``score_counts``. Scores (0 to 1) are moved once, dealt by parts of their range and counted and ranked
    within; a part gives one row, and the parts are ranked among each other, so
    no task ranks a whole model. NULL where a class is missing."""
    part = F.least(F.floor(F.col("s") * SCORE_PARTS), F.lit(SCORE_PARTS - 1))
    earlier = (Window.unboundedPreceding, -1)
    counts = scored if {"s", "pos", "neg"} <= set(scored.columns) else counted(scored, *by, label=label, score=score)
    values = (counts.withColumn("part", part).repartition(*by, "part")
              .groupBy(*by, "part", "s").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    inside = F.coalesce(F.sum("neg").over(Window.partitionBy(*by, "part").orderBy("s").rowsBetween(*earlier)), F.lit(0))
    parts = (values.withColumn("inside", inside).groupBy(*by, "part")
             .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum(F.col("pos") * (F.col("inside") + F.col("neg") / 2)).alias("area")))
    lower = F.coalesce(F.sum("neg").over(Window.partitionBy(*by).orderBy("part").rowsBetween(*earlier)), F.lit(0))
    return (parts.withColumn("area", F.col("area") + F.col("pos").cast("double") * lower).groupBy(*by)
            .agg(F.try_divide(F.sum("area"), F.sum("pos").cast("double") * F.sum("neg")).alias("auc")))
