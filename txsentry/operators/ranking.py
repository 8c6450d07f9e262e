"""Exact running totals over a global order, without a single-task window.

``Window.orderBy(v)`` with no partition key puts every row in one task. The
operators that need ranks (exact quantiles, ROC / PR areas, the rank-sum test)
use this instead:

1. aggregate to one row per distinct value (map-side partial aggregation, so a
   value that holds a third of all rows becomes one row before the shuffle);
2. range-partition the distinct values (Spark samples the bounds), tag each row
   with its partition number, which is monotone in the value, and write the tagged
   rows once to the shared scratch folder: both uses below read the same tags. (A
   second planning of the range shuffle may sample other bounds.)
3. per-partition totals (one row per partition, a bounded table) give the
   offset of each partition by a window over those few rows;
4. a window partitioned by the tag gives the running sum inside a partition;
   offset + local running sum = the global running sum.

Every step is a DataFrame operation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txsentry.session import scratch_path


def _partitions(df: DataFrame, partitions: int | None) -> int:
    if partitions:
        return int(partitions)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def running_totals(
    counts: DataFrame,
    order_col: str,
    sum_cols: list[str],
    ascending: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``cum_<c>`` (inclusive running sum in value order) and ``tot_<c>`` (grand total)
    for each column in ``sum_cols``. ``counts`` must have one row per distinct ``order_col``
    value (NULL values are dropped)."""
    n = _partitions(counts, partitions)
    key = F.col(order_col) if ascending else F.col(order_col).desc()
    tagged = (
        counts.filter(F.col(order_col).isNotNull())
        .repartitionByRange(n, key)
        .withColumn("_part", F.spark_partition_id())
    )
    path = scratch_path(counts.sparkSession, "running-totals")
    tagged.write.parquet(path)
    tagged = counts.sparkSession.read.schema(tagged.schema).parquet(path)
    part_tot = tagged.groupBy("_part").agg(*[F.sum(c).alias(f"_pt_{c}") for c in sum_cols])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    offsets = part_tot.select(
        "_part",
        *[F.coalesce(F.sum(f"_pt_{c}").over(before), F.lit(0)).alias(f"_off_{c}") for c in sum_cols],
        *[F.sum(f"_pt_{c}").over(everything).alias(f"tot_{c}") for c in sum_cols],
    )
    local = Window.partitionBy("_part").orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = tagged.select("*", *[F.sum(c).over(local).alias(f"_loc_{c}") for c in sum_cols])
    # ``offsets`` has one row per partition: its size is bounded by ``n``, not by the data.
    out = out.join(F.broadcast(offsets), "_part")
    return out.select(
        *[c for c in counts.columns],
        *[(F.col(f"_off_{c}") + F.col(f"_loc_{c}")).alias(f"cum_{c}") for c in sum_cols],
        *[F.col(f"tot_{c}") for c in sum_cols],
    )


def value_counts(df: DataFrame, value: Column | str, sums: dict[str, Column] | None = None, name: str = "v") -> DataFrame:
    """One row per distinct value with ``n`` (row count) and any extra sums."""
    value = F.col(value) if isinstance(value, str) else value
    sums = sums or {}
    return df.groupBy(value.alias(name)).agg(
        F.count(F.lit(1)).alias("n"), *[expr.alias(k) for k, expr in sums.items()]
    )
