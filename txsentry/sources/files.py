"""File sources and sinks: CSV in, Parquet in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from txsentry.sources.tables import TX_SCHEMA


def read_csv(spark: SparkSession, path: str, schema: T.StructType = TX_SCHEMA, sep: str = ",") -> DataFrame:
    """Header CSV with a fixed schema and no inference. Malformed fields become NULL
    (permissive mode). Only files directly in ``path`` are read."""
    return (
        spark.read.schema(schema)
        .option("header", "true")
        .option("inferSchema", "false")
        .option("sep", sep)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", "true").csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: list[str] | None = None) -> str:
    """Write Parquet. The default mode fails when the path exists, as a run-stamped
    output should never be overwritten silently."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Cut lineage through a written table in the shared scratch folder and read it back.
    Survives executor loss, unlike a cache or a local checkpoint."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
