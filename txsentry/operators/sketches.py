"""Quantiles from stored sketches: one KLL sketch per day and run, merged when needed.

The cleaning job runs every few minutes, its fence should rest on more than the newest rows,
and old rows should not be read again for it. So each run adds one small row per day to a
table of sketches (a few kilobytes, whatever the number of transactions). Merging the rows of
any set of days and runs, in any order, gives quantiles within the sketch's rank error of
the rows behind them. A run that is repeated replaces its own rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SKETCH_K = 1024
#: Normalised rank error of one side that a sketch of SKETCH_K keeps with 99 % confidence.
RANK_ERROR = 0.004

SKETCH_SCHEMA = T.StructType([T.StructField("n", T.LongType()), T.StructField("sketch", T.BinaryType()), T.StructField("day", T.IntegerType()), T.StructField("run", T.StringType())])


def day_sketches(df: DataFrame, col: str, day: Column | str = "tx_time_days", k: int = SKETCH_K) -> DataFrame:
    """(day, n, sketch): the values of each day; NULL and NaN values are left out, a NULL day
    is a day of its own. Partial sketches are merged map-side, so a day that holds a third
    of the rows ships one row a task."""
    day = F.col(day) if isinstance(day, str) else day
    v = F.col(col).cast("double")
    rows = df.select(day.cast("int").alias("day"), v.alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    return rows.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("v", F.lit(k)).alias("sketch"))


def store(sketches: DataFrame, path: str, run: str) -> None:
    """Add one run's sketches to the table at ``path``; a repeated run replaces its rows."""
    out = sketches.select("n", "sketch", "day")
    out.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/run={run}")


def stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SKETCH_SCHEMA).parquet(path)


def merged(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One row per group (all rows without ``by``): n and the merged sketch."""
    return sketches.groupBy(*(by or [])).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def quantiles_from(sketches: DataFrame, probs: list[float]) -> DataFrame:
    """One row with ``q<i>`` per share and ``n``, over all the rows' values; NULL without any."""
    one = merged(sketches.filter(F.col("n") > 0))
    at = F.kll_sketch_get_quantile_double(F.col("sketch"), F.array(*[F.lit(float(p)) for p in probs]))
    one = one.select(F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.when(F.col("n") > 0, at).alias("_q"))
    return one.select(*[F.get("_q", F.lit(i)).alias(f"q{i}") for i in range(len(probs))], "n")
