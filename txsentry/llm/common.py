"""Shared steps: table reading, staging to the shared folder, distributed prefix
sums over an order, and connected components. All of it is DataFrame work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txsentry.session import scratch_path

#: What counts as a word in the corpus contracts: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a DataFrame to the shared scratch folder and read it back: one copy that
    every executor sees, a fixed row placement and a cut lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def packed(docs: DataFrame) -> DataFrame:
    """The whole row as one column ``_doc`` beside doc_id and text, so that no column of
    the caller meets a column that an operator adds; ``select("_doc.*")`` undoes it."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), "doc_id", "text")


def crc_mod(column: str, k: int) -> Column:
    """crc32 of the column's text modulo k; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(k))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked(df: DataFrame, by: list[str], order: list[Column], name: str) -> DataFrame:
    """Add ``rank``: the 1-based position of each row inside its ``by`` group in the
    given order, with no group in one task.

    Rows are range-partitioned by (group, order), so a group that holds a third of all
    rows spreads over many partitions, and written once with their partition number (a
    second planning of the same range shuffle may sample other bounds). Row counts per
    (partition, group) give each partition its offset. Rows equal in every order column
    share a partition and take ranks in any order among themselves.
    """
    n = shuffle_width(df.sparkSession)
    parts = stage(df.repartitionByRange(n, *[F.col(c).asc_nulls_last() for c in by], *order).withColumn("_part", F.spark_partition_id()), name)
    counts = parts.groupBy("_part", *by).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("_part").alias("_p"), *[F.col(c).alias(f"_by_{c}") for c in by], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = Window.partitionBy("_part", *by).orderBy(*order)
    on = F.col("_part") == F.col("_p")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    out = parts.withColumn("_rn", F.row_number().over(local)).join(offsets, on)
    return out.select(*df.columns, (F.col("_rn") + F.col("_off")).cast("long").alias("rank"))


def components(edges: DataFrame, name: str = "cc", max_rounds: int = 100) -> DataFrame:
    """Connected components of an undirected edge list (a, b) by alternating large-star
    and small-star steps. Returns (node, root) for every node that has an edge; root is
    the smallest node of its component.

    Each step is one minimum per node (partial aggregation, so a node with very many
    links costs one row per task) and one join. The edge list is written to the shared
    folder each round; only its row count and a checksum reach the driver.
    """
    spark = edges.sparkSession

    def both(e: DataFrame) -> DataFrame:
        return e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def sign(e: DataFrame) -> tuple:
        r = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return r["n"], r["h"]

    # edges point from the larger node to the smaller one
    current = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), name)
    last = sign(current)
    for _ in range(max_rounds):
        if last[0] == 0:
            break
        # large star: every larger neighbour of u is linked to the smallest of u's neighbourhood
        two = both(current)
        low = two.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = two.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: u and its smaller neighbours are linked to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        current = stage(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), name)
        now = sign(current)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
