"""A training corpus from raw documents, stage by stage.

Each stage is a function (spark, docs, sf_dir) -> DataFrame that calls one
operator of ``ordermart.llm``; its result is written as Parquet and read again
as the next stage's documents. All but the last return the columns of
documents. Texts that a stage has changed keep their other columns, except
that ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermart.llm import decontam, minhash, mixing, queries, rules, token_ids
from ordermart.plans.session import cut_lineage


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; frequent lines go from the texts of the others."""
    return _counted(rules.clean(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return minhash.keep_one(docs, width=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages go from the texts; mostly copied documents go."""
    return _counted(decontam.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources' documents to their target weights, drawn ones as often as drawn."""
    return mixing.mixed(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids written with Elias-Fano boundaries; a row per document read back."""
    return token_ids.token_table(docs, queries.tokenizer_path())


STAGES = [("quality_rules", quality_rules), ("minhash_near_dedup", near_dedup), ("decontamination", decontaminate),
          ("mixing", mix), ("token_ids", tokenize)]

#: MinHash classes, the seeded mix and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
