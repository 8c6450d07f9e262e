"""The corpus pipeline: documents in, a cleaned and mixed corpus out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes a stage's
result as Parquet to the shared scratch folder and hands it, read back, to the next one.
All but the last stage return the columns of ``documents``. Beside the rows that a
stage is told to drop, nothing goes: nulls, empty texts, repeated ids and empty tables
are handled as each operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txsentry.llm import decontaminate, line_dedup, mixing, simhash, toxicity
from txsentry.llm.common import packed, stage, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    scored = toxicity.toxicity(packed(docs), table(spark, sf_dir, "labels"), keep=["_doc"])
    return scored.filter("predicted = 0").select("_doc.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines and sentences whose template recurs stay in one document only."""
    out = line_dedup.dedup_lines(docs)
    size = F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", size).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.keep_first(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated with benchmark passages go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus: each document as often as it is drawn, with its copy number."""
    return mixing.emit(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_neardup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix),
]

#: A trained classifier has no SQL form; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
