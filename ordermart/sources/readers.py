"""Readers and writers for the raw tables and the derived outputs."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import CLEAN, RAW, TABLES

# The public marketplace dataset's file names.
DEFAULT_FILES = {
    "orders": "olist_orders_dataset",
    "customers": "olist_customers_dataset",
    "order_items": "olist_order_items_dataset",
    "products": "olist_products_dataset",
    "sellers": "olist_sellers_dataset",
    "payments": "olist_order_payments_dataset",
    "reviews": "olist_order_reviews_dataset",
    "geolocation": "olist_geolocation_dataset",
    "category_translation": "product_category_name_translation",
}


#: Tables whose CSV may hold line breaks inside quotes; the files of the others are split.
MULTI_LINE = {"reviews", "category_translation"}
_BAD = "_not_parsed"


def _first_line(spark: SparkSession, fs, status) -> str:
    """A file's first line, read by the driver through Spark's file systems."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(status.getPath())
    stream = fs.open(status.getPath())
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
    try:
        return reader.readLine() or ""
    finally:
        reader.close()


def headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The CSV files at ``path`` (a file, folder or glob) by their header: one
    line per file comes to the driver. Empty files and those whose names
    begin with ``_`` or ``.`` are left out."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out: dict[tuple[str, ...], list[str]] = {}
    for top in fs.globStatus(root) or []:
        for f in fs.listStatus(top.getPath()) if top.isDirectory() else [top]:
            if f.isDirectory() or not f.getLen() or f.getPath().getName()[0] in "_.":
                continue
            names = tuple(x.strip() for x in next(csv.reader([_first_line(spark, fs, f).lstrip("\ufeff")]), []))
            out.setdefault(names, []).append(f.getPath().toString())
    return out


def _csv_rows(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The table's columns as text, each file bound by its own header, with
    ``_file``, ``_record`` (a line that has not the header's columns) and ``_whole``."""
    found = headers(spark, path)
    if not found:
        raise ValueError(f"{path}: no CSV file")
    want, out = [f.name for f in RAW[name].fields], None
    for names, files in sorted(found.items()):
        missing = [c for c in want if c not in names]
        if missing:
            raise ValueError(f"{files[0]}: no column {', '.join(missing)}")
        if len(set(names)) < len(names):
            raise ValueError(f"{files[0]}: a column name stands twice")
        schema = T.StructType([T.StructField(c, T.StringType()) for c in (*names, _BAD)])
        df = (spark.read.schema(schema).option("header", True).option("multiLine", name in MULTI_LINE).option("quote", '"')
              .option("escape", '"').option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BAD)
              .option("columnPruning", False).csv(files))
        df = df.select(*[F.col(f"`{c}`") for c in want], F.col("_metadata.file_path").alias("_file"), F.col(_BAD).alias("_record"),
                       F.to_csv(F.struct(*[F.col(f"`{c}`") for c in names])).alias("_whole"))
        out = df if out is None else out.unionByName(df)
    return out


def _typed(rows: DataFrame, name: str) -> tuple[DataFrame, list[str]]:
    """The columns cast to the raw schema, and ``_reason``: why a row is bad, or NULL."""
    fields = RAW[name].fields
    wrong = [F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f"type of {f.name}"))
             for f in fields if f.dataType != T.StringType()]
    reason = F.coalesce(F.when(F.col("_record").isNotNull(), F.lit("number of columns")), *wrong) if wrong else \
        F.when(F.col("_record").isNotNull(), F.lit("number of columns"))
    return rows.withColumn("_reason", reason), [f.name for f in fields]


def read_quarantined(spark: SparkSession, path: str, name: str) -> tuple[DataFrame, DataFrame]:
    """A raw CSV table in two: its rows, and the lines that are none, as
    (file, record, reason) -- a wrong number of columns, or text where the
    schema has a number."""
    rows, names = _typed(_csv_rows(spark, path, name), name)
    good = rows.where("_reason IS NULL").select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in RAW[name].fields])
    bad = rows.where("_reason IS NOT NULL").select(F.col("_file").alias("file"), F.coalesce("_record", "_whole").alias("record"),
                                                   F.col("_reason").alias("reason"))
    return good, bad


def read_table(spark: SparkSession, path: str, name: str, fmt: str = "csv") -> DataFrame:
    """One raw table, its columns bound by name in each file; extra columns
    are ignored, a missing one is an error.

    CSV: read as text (quoted line breaks and doubled quotes allowed in the
    tables ``MULTI_LINE``; files of the others are split among tasks), then
    cast to the schema; time columns stay text (cleaned by
    ``operators.clean``). A bad line is an error that names its file; see
    ``read_quarantined``. Parquet is read with its own types.
    """
    if fmt == "csv":
        rows, _ = _typed(_csv_rows(spark, path, name), name)
        stop = F.raise_error(F.concat(F.col("_file"), F.lit(": "), F.col("_reason"), F.lit(": "), F.coalesce("_record", "_whole")))
        return rows.where(F.when(F.col("_reason").isNull(), F.lit(True)).otherwise(stop.cast("boolean"))).select(
            *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in RAW[name].fields])
    df = spark.read.format(fmt).load(path)
    cols = [f.name for f in CLEAN[name].fields if f.name in df.columns]
    return df.select(*cols)


def load_tables(spark: SparkSession, root: str, fmt: str = "csv",
                files: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """All raw tables under ``root`` (one file or folder per table)."""
    files = {**DEFAULT_FILES, **(files or {})}
    ext = {"csv": ".csv", "parquet": ""}.get(fmt, "")
    return {t: read_table(spark, f"{root}/{files[t]}{ext}", t, fmt) for t in TABLES}


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                fmt: str = "parquet") -> None:
    """Write an output (e.g. the zip dimension or the feature table)."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
