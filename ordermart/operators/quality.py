"""Integrity checks: database constraints re-aimed as data-quality queries (#13-#18).

Each check returns the violating rows (empty DataFrame = constraint holds),
so it runs as one distributed job and never collects the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pk_violations(df: DataFrame, key: str) -> DataFrame:
    """#13: key values that are NULL or repeat, with their row counts."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
              .where(F.col(key).isNull() | (F.col("n_rows") > 1))
              .select(F.col(key).alias("key_value"), "n_rows"))


def fk_violations(child: DataFrame, child_key: str, parent: DataFrame,
                  parent_key: str) -> DataFrame:
    """#14-#18: non-null child keys with no parent row, with their row counts.

    NULL child keys pass, as in SQL. A left-anti join on non-null keys
    avoids the null-aware anti join that NOT IN would need.
    """
    keys = child.where(F.col(child_key).isNotNull()) \
                .groupBy(child_key).agg(F.count(F.lit(1)).alias("n_rows"))
    parents = parent.select(F.col(parent_key).alias("_pk")).where(F.col("_pk").isNotNull())
    return (keys.join(parents, keys[child_key] == parents["_pk"], "left_anti")
                .select(F.col(child_key).alias("key_value"), "n_rows"))


def pk_report(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Primary-key violations of several tables in one frame."""
    out = None
    for name, (df, key) in tables.items():
        v = pk_violations(df, key).select(F.lit(name).alias("table_name"), "key_value", "n_rows")
        out = v if out is None else out.unionByName(v)
    return out
