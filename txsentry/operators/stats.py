"""Descriptive statistics in one pass per table, returned in long form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _stack(df: DataFrame, cols: list[str], fields: list[str]) -> DataFrame:
    """One row of ``<field>__<col>`` values -> one row per column."""
    parts = []
    for c in cols:
        parts.append(F.struct(F.lit(c).alias("col_name"), *[F.col(f"{f}__{c}").alias(f) for f in fields]))
    return df.select(F.inline(F.array(*parts)))


def describe(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """count, mean, sample stddev, min, max per numeric column, one aggregate for all columns."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"count__{c}"),
            F.avg(x).alias(f"mean__{c}"),
            F.stddev_samp(x).alias(f"stddev__{c}"),
            F.min(x).alias(f"min__{c}"),
            F.max(x).alias(f"max__{c}"),
        ]
    return _stack(df.agg(*aggs), cols, ["count", "mean", "stddev", "min", "max"])


def schema_profile(df: DataFrame, cols: list[str] | None = None, exact: list[str] | None = None, rsd: float = 0.01) -> DataFrame:
    """Per column: type name, row count, NULL count and distinct count.

    Distinct counts come from HyperLogLog++ sketches (relative error ``rsd``), which
    merge map-side in the same aggregate as the other counts. The columns named in
    ``exact`` are counted exactly instead, each by its own two-step aggregate (its
    distinct values are shuffled; no row is expanded once per column).
    """
    cols = cols or df.columns
    exact = [c for c in cols if c in set(exact or [])]
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    aggs = [F.count(F.lit(1)).alias("rows__all")]
    for c in cols:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"nulls__{c}"))
        if c not in exact:
            aggs.append(F.approx_count_distinct(F.col(c), rsd).alias(f"distinct__{c}"))
    one = df.agg(*aggs)
    one = one.withColumns({f"distinct__{c}": df.select(c).distinct().agg(F.count(c)).scalar() for c in exact})
    parts = [
        F.struct(
            F.lit(c).alias("col_name"),
            F.lit(types[c]).alias("data_type"),
            F.col("rows__all").alias("n_rows"),
            F.col(f"nulls__{c}").alias("n_null"),
            F.col(f"distinct__{c}").alias("n_distinct"),
        )
        for c in cols
    ]
    return one.select(F.inline(F.array(*parts)))


def histogram(df: DataFrame, value: str, bins: int = 3, by: list[str] | None = None) -> DataFrame:
    """Equal-width histogram per group over the group's own [min, max]; the last bin
    includes its right edge (the usual plotting convention). NULLs are left out.

    The per-group range is a grouped aggregate joined back. It has one row per
    group, but the number of groups is not bounded by anything, so no broadcast is
    forced: adaptive execution broadcasts it when its measured size is under
    ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and otherwise keeps a
    sort-merge join whose hot partitions (one group with a large share of the
    rows) are split by the skew-join rule.
    """
    by = list(by or [])
    x = df.filter(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_x"))
    rng = x.groupBy(*by).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    if by:
        j = x.join(rng, by, "inner")
    else:
        j = x.withColumns({"_lo": rng.select("_lo").scalar(), "_hi": rng.select("_hi").scalar()})
    width = F.col("_hi") - F.col("_lo")
    idx = F.when(width > 0, F.least(F.floor((F.col("_x") - F.col("_lo")) / width * F.lit(bins)), F.lit(bins - 1))).otherwise(F.lit(0))
    counted = j.groupBy(*by, idx.cast("int").alias("bin"), "_lo", "_hi").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        *by,
        "bin",
        (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("bin") / F.lit(bins)).alias("bin_lo"),
        (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("bin") + 1) / F.lit(bins)).alias("bin_hi"),
        "n",
    )
