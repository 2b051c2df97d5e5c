"""Session defaults and written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings the library relies on: UTC wall clock for TIMESTAMP_NTZ math,
# ANSI casts (a malformed timestamp is an error, not a silent NULL), AQE for
# runtime join selection, partition coalescing and skew splitting.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "ordermart", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``,
    or the folder given to ``SparkContext.setCheckpointDir``.

    There is no fallback: a folder that only one machine sees would lose
    rows on a cluster. Without a setting this raises ``ValueError``.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors "
                         "share; intermediate tables are written there")
    return d


def use_local_scratch(spark: SparkSession) -> None:
    """For tests and single-machine runs (``local[...]`` masters) only: name
    a private scratch folder where none is set. Elsewhere it does nothing."""
    sc = spark.sparkContext
    if (sc.master.startswith("local[") or sc.master == "local") \
            and not spark.conf.get("spark.checkpoint.dir", None) and not sc.getCheckpointDir():
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ordermart-scratch-"))


class Scratch:
    """Owner of the intermediate tables written through it; ``release()``
    removes them once the frames that read them are no longer needed."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []
        self.names: list[str] = []

    def path(self) -> str:
        """A new folder of this owner's in the shared one."""
        self.paths.append(f"{checkpoint_dir(self.spark).rstrip('/')}/tables/{uuid.uuid4().hex}")
        return self.paths[-1]

    def materialize(self, df: DataFrame, codec: str | None = None) -> DataFrame:
        path = self.path()
        (df.write.option("compression", codec) if codec else df.write).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def bucketed(self, df: DataFrame, key: str, codec: str | None = None) -> tuple[str, str]:
        """``df`` as a table of the catalog in buckets of ``key``: its name and folder."""
        path = self.path()
        self.names.append(f"kept_{uuid.uuid4().hex}")
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        # nothing is moved if the joins before have dealt the rows by the key
        writer = df.repartition(key).write.format("parquet").bucketBy(buckets, key).option("path", path)
        (writer.option("compression", codec) if codec else writer).saveAsTable(self.names[-1])
        return self.names[-1], path

    def release(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        jvm = self.spark.sparkContext._jvm
        for path in self.paths:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        self.paths, self.names = [], []


_SCRATCH: dict[str, Scratch] = {}


def scratch(spark: SparkSession) -> Scratch:
    """The application's default owner."""
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        _SCRATCH[app] = Scratch(spark)
    return _SCRATCH[app]


def release(spark: SparkSession) -> None:
    """Delete every table written so far by ``cut_lineage`` in this application."""
    scratch(spark).release()


def cut_lineage(df: DataFrame, enabled: bool = True, codec: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder now
    and continue from it; ``enabled=False`` returns ``df`` unchanged. ``codec``
    names another compression than the session's.

    Parquet rather than ``Dataset.checkpoint()``: the table is columnar and
    compressed, so later readers prune columns and push filters instead of
    deserializing whole rows, and it survives executor loss like any written
    table. Never a local (executor-disk) checkpoint.
    """
    return scratch(df.sparkSession).materialize(df, codec) if enabled else df


#: Rows of one key from which on a bucketed table is read without its buckets.
HOT_KEY_ROWS = 1_000_000


def cut_bucketed(df: DataFrame, key: str, codec: str | None = None, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """``cut_lineage`` in as many buckets of ``key`` as a shuffle has
    partitions: grouping the table by the key needs no exchange. A bucket is
    one task and can't be split, so with a key of more than ``hot_rows`` rows
    the same files are read without their buckets."""
    spark = df.sparkSession
    name, path = scratch(spark).bucketed(df, key, codec)
    kept = spark.table(name)
    most = kept.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    return kept if most <= hot_rows else spark.read.schema(kept.schema).parquet(path)
