"""Encoding and scaling (#71-#74)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.session import cut_lineage

# The ordinal coding of order statuses used by the pipeline.
STATUS_CODES = {
    "delivered": 6,
    "shipped": 5,
    "canceled": 4,
    "invoiced": 3,
    "processing": 2,
    "approved": 1,
    "created": 0,
}

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)


def label_encode(df: DataFrame, cols: list[str], mapping: dict = STATUS_CODES) -> DataFrame:
    """#71: dictionary lookup; unmapped values -> NULL (literal map, no join)."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return df.withColumns({c: F.try_element_at(m, F.col(c)) for c in cols})


def category_values(df: DataFrame, col: str, max_categories: int | None = None) -> list:
    """Sorted distinct non-NULL values of ``col``, fetched once: the output
    schema of one-hot coding depends on them. A caller may pass
    ``max_categories`` to get an error instead of a very wide result."""
    found = df.where(F.col(col).isNotNull()).select(col).distinct().orderBy(col)
    vals = (found if max_categories is None else found.limit(max_categories + 1)).collect()
    if max_categories is not None and len(vals) > max_categories:
        raise ValueError(f"{col}: more than {max_categories} categories")
    return [r[0] for r in vals]


def one_hot(df: DataFrame, cols: list[str], categories: dict[str, list] | None = None,
            max_categories: int | None = None) -> DataFrame:
    """#72: ``{col}_{value}`` 0/1 columns for the sorted categories minus the
    first; NULL -> all zeros; the source column is dropped (T20).

    The categories are read from the data (one small aggregate per column).
    Pass ``categories`` for a stable schema; a value of the data that is not
    among them is an error when the result is computed, never all zeros.
    """
    categories = categories or {}
    out = df
    for c in cols:
        given = categories.get(c)
        vals = sorted(given if given is not None else category_values(df, c, max_categories))
        if given is not None:
            # a filter, so that the check stays when the dummies are not read (or there are none)
            unlisted = F.raise_error(F.concat(F.lit(f"{c}: value not among the categories: "), F.col(c).cast("string")))
            out = out.where(F.when(F.col(c).isNull() | F.col(c).isin(vals), F.lit(True)).otherwise(unlisted.cast("boolean")))
        dummies = {f"{c}_{v}": F.coalesce(F.col(c) == F.lit(v), F.lit(False)).cast("int") for v in vals[1:]}
        out = out.withColumns(dummies).drop(c)
    return out


def frequency_encode(df: DataFrame, cols: list[str]) -> DataFrame:
    """#73: raw count of each value as ``{col}_freq``; NULL -> NULL (T9).

    Counts come from a ``groupBy`` (partial aggregation, so a hot value is
    one pre-aggregated row per task) joined back on the value. The count
    tables have one row per distinct value and are written by this call: of
    known size, a small one is broadcast before any row of ``df`` is moved.
    """
    out = df
    for c in cols:
        counts = cut_lineage(df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("_fv"))
                             .agg(F.count(F.lit(1)).alias(f"{c}_freq")))
        out = out.join(counts, out[c] == counts["_fv"], "left").drop("_fv", c)
    return out


def numeric_columns(df: DataFrame, exclude: set[str] = frozenset()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def zscore(df: DataFrame, cols: list[str] | None = None, binary: set[str] = frozenset(),
           eps: float = 1e-10) -> DataFrame:
    """#74: (x - mean) / (sample std + eps) on numeric columns with more than
    two distinct non-NULL values (T21).

    ``binary`` names columns known to hold at most two values (dummies,
    target); they are never scaled and keep their type. The other
    candidates become DOUBLE. "More than two distinct" is decided without a
    wide COUNT DISTINCT: one pass gives min/max/mean/std, a second the flag
    "some value differs from both min and max". Like ``StandardScaler``,
    it is a fit then a transform: each pass is one distributed aggregate
    whose single row (four numbers and a flag per column, bounded by the
    schema, not the data) comes back to the driver, and the transform is a
    projection with those values as literals -- no join, no subquery.
    ``df`` is read three times; pipelines pass a materialized frame.
    """
    cols = [c for c in (cols or numeric_columns(df)) if c not in binary]
    if not cols:
        return df
    return scaled(df, cols, moments(df, cols), eps)


def moments(df: DataFrame, cols: list[str]) -> dict[str, tuple]:
    """Per column (mean, sample std), or (None, None) where it has no more
    than two distinct values: two one-row aggregates."""
    if not cols:
        return {}
    st = df.agg(*[x for c in cols for x in (
        F.min(c).cast("double").alias(f"_lo_{c}"), F.max(c).cast("double").alias(f"_hi_{c}"),
        F.avg(c).alias(f"_mu_{c}"), F.stddev_samp(c).alias(f"_sd_{c}"))]).first().asDict()
    fl = df.agg(*[F.max((F.col(c).cast("double") != F.lit(st[f"_lo_{c}"]))
                        & (F.col(c).cast("double") != F.lit(st[f"_hi_{c}"]))).alias(c)
                  for c in cols]).first().asDict()
    return {c: (st[f"_mu_{c}"], st[f"_sd_{c}"]) if fl[c] else (None, None) for c in cols}


def scaled(df: DataFrame, cols: list[str], found: dict[str, tuple], eps: float = 1e-10) -> DataFrame:
    """The columns as DOUBLE, scaled by the ``moments`` found earlier."""
    out = {}
    for c in cols:
        x, (mean, std) = F.col(c).cast("double"), found[c]
        out[c] = x if mean is None else (x - F.lit(mean)) / (F.lit(std) + F.lit(eps))
    return df.withColumns(out)
