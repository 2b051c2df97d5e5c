"""The composed pipelines (#41, #53, #62, #70, #75)."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import hash_fold
from ..operators import encode, features, fitted, impute, mart, ml, orderlevel
from .session import cut_bucketed, cut_lineage

ONE_HOT_COLS, FREQ_COLS = fitted.ONE_HOT_COLS, fitted.FREQ_COLS


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The fixture's tables; only the functions over an ``sf_dir`` need them."""
    from ..sources import fixtures

    return fixtures.load(spark, sf_dir)


def orders_master(spark: SparkSession, sf_dir: str, status: str | None = None) -> DataFrame:
    """#41. With ``status`` only that status's orders, and no item of another
    order is looked up and moved: a filter by status finds the same rows."""
    t = tables(spark, sf_dir)
    if status is not None:
        t["orders"] = t["orders"].where(F.col("order_status") == status)
        t["order_items"] = t["order_items"].join(t["orders"].select("order_id"), "order_id", "left_semi")
    return mart.build_mart(t)


def imputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impute.impute_all(orders_master(spark, sf_dir, impute.DELIVERED), by_order=True)


def featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.add_features(imputed(spark, sf_dir))


def order_level(spark: SparkSession, sf_dir: str, dedupe: bool = False,
                checkpoint: bool = True, columns: list[str] | None = None) -> DataFrame:
    """#70 on the featured mart. With ``checkpoint`` the one-row-per-order
    result is materialized, because encoding and scaling read it several times.
    ``columns``: those the caller reads; the others are not computed and written."""
    rows = featured(spark, sf_dir)
    # the rows are dealt by the order, and stay so when one per item is left: they are not moved as by ``dedupe=True``
    ol = orderlevel.order_level(orderlevel.dedupe_items(rows) if dedupe else rows)
    ol = ol.select(*columns) if columns else ol
    return cut_lineage(ol, checkpoint, impute.CODEC)


def encode_and_scale(ol: DataFrame, one_hot_cols=ONE_HOT_COLS, freq_cols=FREQ_COLS,
                     categories: dict[str, list] | None = None) -> DataFrame:
    """#72 -> #73 -> #74 on an order-level frame."""
    cats = {c: encode.category_values(ol, c) for c in one_hot_cols if c not in (categories or {})}
    cats.update(categories or {})
    enc = encode.one_hot(ol, one_hot_cols, cats)
    # z-scoring reads its input three times (two statistics passes and the
    # result): materialize the encoded frame once instead of redoing the joins
    enc = cut_lineage(encode.frequency_encode(enc, freq_cols), codec=impute.CODEC)
    binary = {f"{c}_{v}" for c in one_hot_cols for v in sorted(cats[c])[1:]} | {"bad_review"}
    return encode.zscore(enc, binary=binary)


def preprocess(m: DataFrame, categories: dict[str, list] | None = None, checkpoint: bool = True,
               by_order: bool = False) -> DataFrame:
    """#75 on a mart of the caller's (the 38 columns of ``mart.MART_COLS``): the
    model-ready table. Imputing, coding and scaling run jobs and write tables
    while the plan is built. ``by_order``: see ``impute.impute_all``."""
    ol = orderlevel.order_level(features.add_features(impute.impute_all(m, by_order=by_order)))
    return encode_and_scale(cut_lineage(ol, checkpoint, impute.CODEC), categories=categories)


def _folded_rows(m: DataFrame, k: int, by_order: bool) -> DataFrame:
    """The filtered mart with outer folds, written; ``by_order``: see ``impute.impute_all``."""
    base = ml.add_folds(fitted.base_rows(m), k=k)
    return cut_bucketed(base, "order_id", codec=impute.CODEC) if by_order else cut_lineage(base, codec=impute.CODEC)


def _fit_without(base: DataFrame, f: int, k: int) -> tuple[fitted.RiskFeaturesModel, DataFrame]:
    """What the other folds' rows teach, and the feature table of all orders by it."""
    model, ol = fitted.RiskFeatures().learn(base.where(F.col("fold") != f).drop("fold"), base.drop("fold"),
                                            hash_fold("order_id", k, str(ml.SEED)) == f)
    return model, ml.add_folds(model.coded_and_scaled(ol), k=k)


def fit_on_train(m: DataFrame, f: int = 0, k: int = ml.N_SPLITS, by_order: bool = False) -> DataFrame:
    """The feature table with imputation, coding and scaling learned without
    fold ``f``; ``held_out`` tells its orders. The filtered mart is written
    once, for what is learned and for the rows that are coded."""
    _, table = _fit_without(_folded_rows(m, k, by_order), f, k)
    return table.withColumn("held_out", F.col("fold") == f).drop("fold")


def cv_fit_on_train(m: DataFrame, k: int = ml.N_SPLITS, grid=ml.GRID_C, null_as: float | None = 0.0,
                    by_order: bool = False) -> DataFrame:
    """#82 with T25 mended: for each outer fold of orders, imputation, coding
    and scaling are learned from the other folds' rows of the mart, the grid
    is searched on them, and the held-out orders are predicted; the metrics
    averaged over the folds. The filtered mart is written once for all folds;
    a fold's imputed orders are written once, for what is learned from its
    training orders and for the feature table."""
    base = _folded_rows(m, k, by_order)

    def predicted(f: int) -> DataFrame:
        _, coded = _fit_without(base, f, k)
        table = cut_lineage(ml.assemble(coded, null_as=null_as)
                            .select("order_id", ml.TARGET, "fold", "features"))
        best, _ = ml.grid_search(table.where(F.col("fold") != f).drop("fold"), grid, k)
        return ml.predict(best, table.where(F.col("fold") == f)).select("fold", ml.TARGET, "prediction", "probability")

    # the folds are independent chains of small jobs: submitted from driver threads, they overlap
    with ThreadPoolExecutor(max_workers=ml.PARALLELISM) as pool:
        said = reduce(DataFrame.unionByName, pool.map(predicted, range(k)))
    return ml.average_metrics(ml.fold_metrics(cut_lineage(said)))


def feature_table(spark: SparkSession, sf_dir: str, categories: dict[str, list] | None = None,
                  checkpoint: bool = True) -> DataFrame:
    """#75 on the mart of the fixture's tables."""
    return preprocess(orders_master(spark, sf_dir, impute.DELIVERED), categories, checkpoint, by_order=True)
