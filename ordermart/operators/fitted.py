"""The feature pipeline as an estimator (T25): what imputation, coding and
scaling learn from a training part, kept as tables and applied to any rows.

``RiskFeatures().fit(mart)`` learns from the rows of a mart; the model's
``transform`` turns a mart into the feature table without looking at it:

* per imputation key, a table of the key's means (of each column at that
  level, after the earlier levels' fills) and category mode;
* the frame-wide values: global means, the stale-mask flags of the review
  cascade, the payment modes;
* the one-hot categories, a count table per frequency-coded column, the
  moments of the scaled columns.

On the training part itself the result is that of ``pipeline.preprocess``.
Elsewhere: a key that was not seen falls to the next level, and stays NULL
after the last; a category that was not seen has no dummy; a value that was
not seen has frequency 0. Tables grow with the distinct keys and are joined,
never collected; the driver holds a few numbers per column and the categories.
"""

from __future__ import annotations

from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader,
                             MLWritable, MLWriter)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.session import cut_lineage
from . import encode, features, impute, orderlevel
from .clean import TARGET

# The encoding choices of the reference pipeline.
ONE_HOT_COLS = ["payment_type", "most_common_seller_state", "customer_state"]
FREQ_COLS = ["customer_city", "most_common_seller_city", "most_common_product_category_name"]


def _specs(masked: bool) -> list[tuple[list[str], list[impute.MeanSpec]]]:
    """The mean cascades with their key tuples."""
    return [(impute.SELLER_KEYS, impute.seller_specs()), (impute.PLACE_KEYS, impute.coord_specs()),
            (impute.CUSTOMER_KEYS, impute.customer_specs(masked=masked))]


def base_rows(mart: DataFrame) -> DataFrame:
    return impute.with_day_offsets(impute.has_product(impute.delivered_only(mart)))


def _learn_means(df: DataFrame, keys: list[str], specs: list[impute.MeanSpec], tables: dict, flags: dict, overall: dict) -> None:
    """Every level's table of all its keys, from the training rows: known
    values, and what the earlier levels have filled (a small table of the key
    tuples with NULLs)."""
    S = cut_lineage(impute.null_tuples(df, keys, [sp.col for sp in specs])
                    .withColumns({impute._fname(sp.col): F.lit(None).cast("double") for sp in specs}))
    by_col = {sp.col: sp for sp in specs}
    for k in impute._level_order(specs):
        cols = [sp.col for sp in specs if k in sp.levels]
        for c in (c for c in cols if by_col[c].stale and by_col[c].levels[0] != k):
            row = S.agg(F.max(F.col(impute._fname(c)).isNull() & (F.col(f"_z_{c}") > 0))).first()
            flags[f"{c}.{k}"] = bool(row[0])
        aggs = [x for c in cols for x in (
            F.sum(F.when(F.col(impute._fname(c)).isNotNull(), F.col(f"_z_{c}") * F.col(impute._fname(c)))).alias(f"_A_{c}"),
            F.sum(F.when(F.col(impute._fname(c)).isNotNull(), F.col(f"_z_{c}"))).alias(f"_B_{c}"))]
        earlier = S.where(F.col(k).isNotNull()).groupBy(F.col(k).alias("_lk")).agg(*aggs)
        zero = F.lit(0.0)
        T = cut_lineage(impute._known(df, k, cols).join(earlier, F.col("_kk") == F.col("_lk"), "full").select(
            F.coalesce("_kk", "_lk").cast("string").alias("_key"), *[impute._safe_div(
                F.coalesce(f"_s_{c}", zero) + F.coalesce(f"_A_{c}", zero),
                F.coalesce(f"_n_{c}", F.lit(0)) + F.coalesce(f"_B_{c}", F.lit(0))).alias(c) for c in cols]))
        tables.setdefault(k, []).append(T)
        S = S.join(T.select(F.col("_key").alias("_tk"), *[F.col(c).alias(f"_m_{c}") for c in cols]),
                   F.col(k).cast("string") == F.col("_tk"), "left")
        new = {}
        for c in cols:
            f, m = F.col(impute._fname(c)), F.col(f"_m_{c}")
            new[impute._fname(c)] = m if flags.get(f"{c}.{k}") else F.coalesce(f, m)
        S = cut_lineage(S.withColumns(new).drop("_tk", *[f"_m_{c}" for c in cols]))
    last = [sp.col for sp in specs if sp.global_level]
    if last:
        known = df.agg(*[x for c in last for x in (F.sum(F.col(c).cast("double")).alias(f"s{c}"), F.count(c).alias(f"n{c}"))]).first()
        filled = S.agg(*[x for c in last for x in (
            F.sum(F.col(f"_z_{c}") * F.col(impute._fname(c))).alias(f"s{c}"),
            F.sum(F.when(F.col(impute._fname(c)).isNotNull(), F.col(f"_z_{c}"))).alias(f"n{c}"))]).first()
        for c in last:
            n = known[f"n{c}"] + (filled[f"n{c}"] or 0)
            overall[c] = ((known[f"s{c}"] or 0.0) + (filled[f"s{c}"] or 0.0)) / n if n else None


def _learn_modes(df: DataFrame, col: str, levels: list[str], tables: dict) -> None:
    """Every level's table of its keys' modes, rows filled earlier included."""
    T = cut_lineage(df.where(F.col(col).isNull()).groupBy(*levels).agg(F.count("*").alias("_z"))
                    .withColumn("_f", F.lit(None).cast(df.schema[col].dataType)))
    for k in levels:
        known = df.where(F.col(col).isNotNull() & F.col(k).isNotNull()).groupBy(F.col(k).cast("string").alias("_key"), F.col(col).alias("_v")) \
            .agg(F.count("*").alias("_n"))
        filled = T.where(F.col("_f").isNotNull() & F.col(k).isNotNull()).select(
            F.col(k).cast("string").alias("_key"), F.col("_f").alias("_v"), F.col("_z").alias("_n"))
        modes = cut_lineage(known.unionByName(filled).groupBy("_key", "_v").agg(F.sum("_n").alias("_n"))
                            .groupBy("_key").agg(F.min_by("_v", F.struct(-F.col("_n"), F.col("_v"))).alias(col)))
        tables.setdefault(k, []).append(modes)
        T = cut_lineage(T.join(modes.select(F.col("_key").alias("_mk"), F.col(col).alias("_m")), F.col(k).cast("string") == F.col("_mk"), "left")
                        .withColumn("_f", F.coalesce("_f", "_m")).drop("_mk", "_m"))


class _Settings(Params):
    oneHotCols = Param(Params._dummy(), "oneHotCols", "columns coded as dummies", TypeConverters.toListString)
    freqCols = Param(Params._dummy(), "freqCols", "columns coded by their values' counts", TypeConverters.toListString)
    maskedReview = Param(Params._dummy(), "maskedReview", "the conventional review cascade", TypeConverters.toBoolean)

    def __init__(self):
        super().__init__()
        self._setDefault(oneHotCols=ONE_HOT_COLS, freqCols=FREQ_COLS, maskedReview=False)


class RiskFeatures(_Settings, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the feature pipeline from a mart (the 38 columns of ``mart.MART_COLS``)."""

    @keyword_only
    def __init__(self, *, oneHotCols=ONE_HOT_COLS, freqCols=FREQ_COLS, maskedReview=False):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, mart: DataFrame) -> RiskFeaturesModel:
        base = cut_lineage(base_rows(mart), codec=impute.CODEC)
        return self.learn(base, base)[0]

    def learn(self, base: DataFrame, rows: DataFrame, held_out: Column | None = None) -> tuple[RiskFeaturesModel, DataFrame]:
        """The model learned from ``base`` (written rows of ``base_rows``) and
        the order level of ``rows`` imputed by it, written once. Where ``rows``
        has more orders than ``base``, ``held_out`` tells them by ``order_id``:
        coding and scaling are not learned from those."""
        state = {"flags": {}, "overall": {}, "categories": {}, "moments": {}}
        parts: dict[str, list[DataFrame]] = {}
        for keys, specs in _specs(self.getOrDefault("maskedReview")):
            _learn_means(base, keys, specs, parts, state["flags"], state["overall"])
        _learn_modes(base, impute.CATEGORY, impute.CATEGORY_KEYS, parts)
        tables = {k: cut_lineage(reduce(lambda a, b: a.join(b, "_key", "full"), ts)) for k, ts in parts.items()}
        state["payment"] = impute.payment_modes(base).first().asDict()
        model = self._copyValues(RiskFeaturesModel(tables, state))
        all_orders = cut_lineage(model.order_level(rows), codec=impute.CODEC)
        ol = all_orders if held_out is None else all_orders.where(~held_out)
        for c in self.getOrDefault("oneHotCols"):
            state["categories"][c] = encode.category_values(ol, c)
        for c in self.getOrDefault("freqCols"):
            tables[f"freq_{c}"] = cut_lineage(ol.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("_key")).agg(F.count("*").alias("n")))
        coded = model._coded(ol)
        binary = {f"{c}_{v}" for c, vs in state["categories"].items() for v in vs} | {TARGET}
        cols = [c for c in encode.numeric_columns(coded) if c not in binary]
        state["scaled"] = cols
        state["moments"] = encode.moments(coded, cols)
        return model, all_orders


class RiskFeaturesModel(_Settings, Model, MLWritable, MLReadable):
    """The learned tables and values; ``transform(mart)`` gives the feature table."""

    def __init__(self, tables: dict[str, DataFrame] | None = None, state: dict | None = None):
        super().__init__()
        self.tables, self.state = tables or {}, state or {}

    def imputed(self, mart: DataFrame) -> DataFrame:
        """The delivered rows with every NULL filled that the tables can fill."""
        specs = [sp for _, some in _specs(self.getOrDefault("maskedReview")) for sp in some]
        keys = {k for sp in specs for k in sp.levels} | set(impute.CATEGORY_KEYS)
        out = impute.with_fills(base_rows(mart), {k: self.tables[k] for k in keys}, specs, self.state["flags"], self.state["overall"],
                                {impute.CATEGORY: impute.CATEGORY_KEYS})
        out = impute._apply_means(out, impute.COORD_COLS + [impute.CATEGORY] + impute.PRODUCT_INFO_COLS
                                  + impute.DIMENSION_COLS + [impute.REVIEW])
        return impute.fill_review_replies(impute.payment_filled(impute._apply_dates(out), self.state["payment"]))

    def order_level(self, mart: DataFrame) -> DataFrame:
        return orderlevel.order_level(features.add_features(self.imputed(mart)))

    def _coded(self, ol: DataFrame) -> DataFrame:
        out = ol
        for c, values in self.state["categories"].items():
            out = out.withColumns({f"{c}_{v}": F.coalesce(F.col(c) == F.lit(v), F.lit(False)).cast("int") for v in values[1:]}).drop(c)
        for c in self.getOrDefault("freqCols"):
            counts = self.tables[f"freq_{c}"].select(F.col("_key").alias("_fv"), F.col("n").alias("_fn"))
            out = out.join(counts, F.col(c) == F.col("_fv"), "left").withColumn(
                f"{c}_freq", F.when(F.col(c).isNotNull(), F.coalesce("_fn", F.lit(0)))).drop("_fv", "_fn", c)
        return out

    def coded_and_scaled(self, ol: DataFrame) -> DataFrame:
        """The feature table of orders that ``order_level`` gave."""
        return encode.scaled(self._coded(ol), self.state["scaled"], self.state["moments"])

    def _transform(self, mart: DataFrame) -> DataFrame:
        return self.coded_and_scaled(self.order_level(mart))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: RiskFeaturesModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession,
                                         {"state": self.model.state, "tables": sorted(self.model.tables)})
        for name, table in self.model.tables.items():
            table.write.parquet(f"{path}/tables/{name}")


class _Reader(MLReader):
    def load(self, path: str) -> RiskFeaturesModel:
        said = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = RiskFeaturesModel({n: self.sparkSession.read.parquet(f"{path}/tables/{n}") for n in said["tables"]}, said["state"])
        model._resetUid(said["uid"])
        DefaultParamsReader.getAndSetParams(model, said)
        return model

