"""Profiling queries (#19-#29). Each is one distributed aggregate; only
the aggregated answer reaches the driver."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..plans.session import cut_lineage
from . import geo

GEO_ZIP = "geolocation_zip_code_prefix"


def zip_duplicates(geolocation: DataFrame, key: str = GEO_ZIP) -> DataFrame:
    """#19: rows, distinct keys and their difference (a NULL key counts as a
    duplicate, as COUNT(DISTINCT) skips it)."""
    return geolocation.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct(key).alias("unique_values"),
    ).withColumn("duplicates_count", F.col("total_rows") - F.col("unique_values"))


def orphan_count(entities: DataFrame, zip_col: str, geolocation: DataFrame,
                 key: str = GEO_ZIP) -> DataFrame:
    """#20/#21: entity *rows* whose zip matches no geolocation row
    (LEFT JOIN ... IS NULL: a NULL zip counts, T2)."""
    zips = geolocation.select(F.col(key).alias("_z")).where(F.col("_z").isNotNull()).distinct()
    orphans = entities.join(zips, entities[zip_col] == zips["_z"], "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias("n_rows"))


def top_zips(zip_geo: DataFrame, n: int = 20) -> DataFrame:
    """#22: the n largest zip prefixes (text order, NULLs first as in the
    source database); a top-k, planned as TakeOrderedAndProject."""
    return zip_geo.select(geo.ZIP).orderBy(F.col(geo.ZIP).desc_nulls_first()).limit(n)


def describe_frame(df: DataFrame) -> DataFrame:
    """#6: the column list with types, whether NULLs are possible, and the
    frame's row count (the shape a printed frame ends with). The column rows
    come from the schema (bounded by the column count); the count is a scalar
    subquery over the whole frame, so no row reaches the driver."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    cols = df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")
    return cols.withColumn("n_rows", df.agg(F.count(F.lit(1))).scalar())


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """#6: the first ``n`` rows by the frame's columns in order (a top-k, so reruns agree)."""
    return df.orderBy(*[F.col(f"`{c}`").asc_nulls_last() for c in df.columns]).limit(n)


def null_counts(df: DataFrame) -> DataFrame:
    """#23: NULLs per column, long form (column_name, n_null), one pass."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "column_name", "n_null")


# The columns whose missing rows are listed.
ROWS_MISSING_COLS = ["order_approved_at", "order_delivered_customer_date", "customer_lat",
                     "product_category_name", "product_weight_g", "review_score",
                     "total_payment", "product_name_lenght", "product_description_lenght"]


def rows_missing(df: DataFrame, cols: list[str] = ROWS_MISSING_COLS) -> DataFrame:
    """#24: rows where a given column is NULL, tagged with the column.

    One scan: each row is expanded to the columns it misses (no union of
    nine filtered scans)."""
    tags = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols]),
                    lambda x: x.isNotNull())
    return df.select(F.explode(tags).alias("missing_column"), *df.columns)


def cardinality(df: DataFrame, cols: list[str], approx_rsd: float | None = None) -> DataFrame:
    """#26: distinct non-NULL values per column, one row. ``approx_rsd``
    switches to HyperLogLog++ (bounded memory per column)."""
    if approx_rsd is None:
        aggs = [F.count_distinct(c).alias(f"nunique_{c}") for c in cols]
    else:
        aggs = [F.approx_count_distinct(c, approx_rsd).alias(f"nunique_{c}") for c in cols]
    return df.agg(*aggs)


def write_profiled(df: DataFrame, metrics: dict[str, Column] | None = None) -> tuple[DataFrame, dict[str, object]]:
    """#23 while a table is written: (the written table, metrics of its rows).

    The metrics -- ``n_rows``, ``null:<column>`` for every column, and any
    further aggregates the caller names -- are observed by the tasks that
    write, so profiling costs no scan of its own. They stand directly below
    the write, in its last stage, where a task that is run again after a lost
    executor is counted once.
    """
    seen = Observation()
    named = {"n_rows": F.count(F.lit(1)), **{f"null:{c}": F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns}, **(metrics or {})}
    table = cut_lineage(df.observe(seen, *[m.alias(name) for name, m in named.items()]))
    return table, seen.get


def observed_nulls(table: DataFrame, seen: dict[str, object]) -> DataFrame:
    """The rows of ``null_counts`` from the metrics of ``write_profiled`` (one per column)."""
    rows = [(c, seen[f"null:{c}"]) for c in table.columns]
    return table.sparkSession.createDataFrame(rows, "column_name string, n_null bigint")


def cardinality_by_column(df: DataFrame, cols: list[str]) -> DataFrame:
    """#26, exact: one row like ``cardinality``, each count a scalar subquery
    over its own column. A columnar table's scans together read each column
    once, values are made distinct in the tasks before their shuffle, and no
    row is expanded into one per column."""
    one = df.sparkSession.range(1)
    return one.select(*[df.where(F.col(f"`{c}`").isNotNull()).select(F.col(f"`{c}`")).distinct().agg(F.count(F.lit(1))).scalar()
                        .alias(f"nunique_{c}") for c in cols])


#: Logarithm of a sketch's buckets: 4096 buckets, 1.04 / sqrt(4096) = 1.6 % standard error.
SKETCH_LOG = 12


def sketch_table(df: DataFrame, cols: list[str], *by: str, log_buckets: int = SKETCH_LOG) -> DataFrame:
    """#26 in parts: (by..., sketch_<column> for each), a HyperLogLog sketch of at
    most a few KB each. Kept as a table, it answers later questions about any
    union of parts (days, states, new batches) without the rows. NULLs are not
    counted; a part without values has an empty sketch."""
    sketches = [F.hll_sketch_agg(F.col(f"`{c}`").cast("string"), log_buckets).alias(f"sketch_{c}") for c in cols]
    return df.groupBy(*by).agg(*sketches)


def merged_cardinality(sketches: DataFrame, cols: list[str], *by: str) -> DataFrame:
    """Distinct values per column over the parts of ``sketches`` (a row per
    ``by``, or one): sketches merge, estimates do not add up."""
    return sketches.groupBy(*by).agg(*[F.hll_sketch_estimate(F.hll_union_agg(f"sketch_{c}")).alias(f"nunique_{c}") for c in cols])


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """#27: distinct values, NULL included."""
    return df.select(col).distinct()


def target_distribution(df: DataFrame, target: str = "bad_review") -> DataFrame:
    """#28: rows per target value."""
    return df.groupBy(target).agg(F.count(F.lit(1)).alias("n_rows"))


def _moments(names: list[str], shifts: list[float]):
    """A task's moments of all column pairs: counts, sums, cross products and
    ranges over the rows where both columns are present, by matrix products."""
    p = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sx, sxx, sxy = (np.zeros((p, p)) for _ in range(4))
        low, high = np.full((p, p), np.inf), np.full((p, p), -np.inf)
        for batch in batches:
            if not batch.num_rows:
                continue
            there = np.column_stack([batch.column(i).is_valid().to_numpy(zero_copy_only=False) for i in range(p)])
            x = np.column_stack([batch.column(i).fill_null(k).to_numpy(zero_copy_only=False) - k for i, k in enumerate(shifts)])
            x[~there] = 0.0
            one = there.astype(float)
            n += one.T @ one
            sx += x.T @ one
            sxx += (x * x).T @ one
            sxy += x.T @ x
            for i in range(p):
                both = there & there[:, [i]]
                low[i] = np.minimum(low[i], np.where(both, x[:, [i]], np.inf).min(axis=0))
                high[i] = np.maximum(high[i], np.where(both, x[:, [i]], -np.inf).max(axis=0))
        parts = [n, sx, sx.T, sxx, sxx.T, sxy, low, low.T, high, high.T]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(p * p), pa.int32()), *[pa.array(m.ravel()) for m in parts]],
                                         names=["pair", *_MOMENTS])
    return run


_MOMENTS = ["n", "sx", "sy", "sxx", "syy", "sxy", "lox", "loy", "hix", "hiy"]


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """#29: Pearson matrix, pairwise complete, long form (col_a, col_b, r).

    Each task keeps the moments of all column pairs for its rows (taken by
    Arrow batches, about the columns' means, so that sums do not cancel) and
    sends one row per pair; moments merge by addition. No row is expanded:
    the shuffle is pairs x tasks rows. r is NULL for fewer than two complete
    rows and where a side is constant on them, which the merged ranges tell
    exactly.
    """
    if not cols:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, r double")
    x = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    means = x.agg(*[F.avg(c) for c in x.columns]).first()
    shifts = [m if m is not None and np.isfinite(m) else 0.0 for m in means]
    sums = (x.mapInArrow(_moments(cols, shifts), "pair int, " + ", ".join(f"{m} double" for m in _MOMENTS))
            .groupBy("pair").agg(*[(F.min if m.startswith("lo") else F.max if m.startswith("hi") else F.sum)(m).alias(m) for m in _MOMENTS]))
    n, (vx, vy) = F.col("n"), [F.col(f"s{a}{a}") - F.col(f"s{a}") * F.col(f"s{a}") / F.col("n") for a in "xy"]
    r = (F.col("sxy") - F.col("sx") * F.col("sy") / n) / (F.sqrt(vx) * F.sqrt(vy))
    names = F.array(*[F.lit(c) for c in cols])
    p = len(cols)
    return sums.select(F.get(names, F.floor(F.col("pair") / p).cast("int")).alias("col_a"), F.get(names, F.col("pair") % p).alias("col_b"),
                       F.when((n >= 2) & (F.col("lox") < F.col("hix")) & (F.col("loy") < F.col("hiy")), r).alias("r"))
