"""Plan-shape and skew properties: what must hold at any scale."""

import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import row, tx_rows
from txsentry.operators import abtest, clean as cl, metrics as me, sampling, stats
from txsentry.operators.ranking import running_totals, value_counts
from txsentry.session import scratch_path


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_pruning_reach_the_scan(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.range(1000).selectExpr("id", "id % 7 AS k", "'x' AS s").coalesce(1).write.parquet(p)
    q = spark.read.parquet(p).filter(F.col("k") == 3).select("id")
    plan = _plan(q)
    assert "PushedFilters: [IsNotNull(k), EqualTo(k,3)]" in plan
    assert "ReadSchema: struct<id:bigint,k:bigint>" in plan
    assert q.count() == len([i for i in range(1000) if i % 7 == 3])


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_many_distinct_values_are_exact(spark, reuse):
    """More distinct values than range sampling looks at, 16 partitions: results equal
    numpy's, whether or not Spark reuses an exchange."""
    old = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        n = 500_000
        df = spark.range(n).select(
            F.col("id").alias("transaction_id"),
            (F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / F.lit(float(1 << 40))).alias("score"),
            (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)) < 20).cast("int").alias("tx_fraud"),
            F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("model"),
        ).withColumn("f1", F.col("score"))
        pdf = df.toPandas()
        x = np.sort(pdf["score"].to_numpy())
        assert len(np.unique(x)) == n
        q = cl.quantiles(df, "score", [0.25, 0.5, 0.75], partitions=16).first()
        assert [q["q0"], q["q1"], q["q2"]] == [x[math.ceil(p * n) - 1] for p in (0.25, 0.5, 0.75)]

        order = pdf.sort_values("score")
        y = order["tx_fraud"].to_numpy()
        pos, neg = int(y.sum()), int((1 - y).sum())
        auc = float((y * np.cumsum(1 - y)).sum()) / (pos * neg)
        assert abs(me.auc_roc(df, partitions=16).first()["auc_roc"] - auc) < 1e-12
        d = y[::-1]
        tp, k = np.cumsum(d), np.arange(1, n + 1)
        prec = tp / k
        before = np.concatenate(([prec[0]], prec[:-1]))
        assert abs(me.auc_pr(df, partitions=16).first()["area_under_pr"] - float((d / pos * (prec + before) / 2).sum())) < 1e-9
        curve = me.pr_curve(df, partitions=16).agg(F.count("*"), F.count_distinct("tp", "fp"), F.sum("tp")).first()
        assert tuple(curve) == (n, n, int(tp.sum()))

        rank = np.empty(n)
        rank[order.index.to_numpy()] = np.arange(1, n + 1)
        a = (pdf["model"] == "A").to_numpy()
        u1 = float(rank[a].sum()) - a.sum() * (a.sum() + 1) / 2
        assert abtest.mann_whitney(df, partitions=16).first()["u1"] == u1
    finally:
        spark.conf.set("spark.sql.exchange.reuse", old)


def test_staged_columns_and_scratch_are_bounded(spark):
    """A metric's staged copy holds the columns it needs, and a scope removes it."""
    from txsentry.session import scratch_scope
    from txsentry.sources import files

    df = tx_rows(spark, [row(i, float(i % 37)) for i in range(200)])
    with scratch_scope():
        path = scratch_path(spark, "dedup")
        cl.clean(df, stage_path=path, keep=["transaction_id", "tx_fraud"]).collect()
        assert set(files.read_parquet(spark, path).columns) == {"transaction_id", "tx_fraud", "tx_amount"}
        assert os.path.exists(path.removeprefix("file:"))
    assert not os.path.exists(path.removeprefix("file:"))


def test_running_totals_with_a_hot_value(spark):
    # one value holds a third of all rows
    vals = [5.0] * 3000 + [float(i % 50) for i in range(6000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = {r["v"]: r["cum_n"] for r in running_totals(value_counts(df, "x"), "v", ["n"], partitions=6).collect()}
    for v in sorted(set(vals)):
        assert got[v] == sum(1 for x in vals if x <= v)


def test_exact_quantile_with_hot_value(spark):
    vals = [7.0] * 400 + [float(i) for i in range(800)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = cl.quantiles(df, "x", [0.25, 0.5, 0.75], partitions=5).first()
    s = sorted(vals)
    for i, p in enumerate([0.25, 0.5, 0.75]):
        assert got[f"q{i}"] == s[math.ceil(p * len(s)) - 1]


def test_histogram_hot_group_no_forced_broadcast(spark):
    rnd = random.Random(3)
    rows = [("hot", rnd.random()) for _ in range(3000)] + [(f"g{i % 40}", rnd.random()) for i in range(6000)]
    df = spark.createDataFrame(rows, "g string, x double")
    h = stats.histogram(df, "x", bins=3, by=["g"])
    got = {(r["g"], r["bin"]): r["n"] for r in h.collect()}
    by = {}
    for g, x in rows:
        by.setdefault(g, []).append(x)
    for g, xs in by.items():
        lo, hi = min(xs), max(xs)
        want = [0, 0, 0]
        for x in xs:
            want[min(int((x - lo) / (hi - lo) * 3), 2)] += 1
        assert [got.get((g, b), 0) for b in range(3)] == want
    assert "strategy=broadcast" not in h._jdf.queryExecution().analyzed().toString()


def test_auc_roc_with_skewed_scores(spark):
    rnd = random.Random(5)
    pairs = [(1 if rnd.random() < 0.3 else 0, 0.5) for _ in range(600)] + [(rnd.randint(0, 1), rnd.random()) for _ in range(1200)]
    df = spark.createDataFrame(pairs, "tx_fraud int, score double")
    auc = me.auc_roc(df, partitions=7).first()["auc_roc"]
    pos = [s for y, s in pairs if y == 1]
    neg = [s for y, s in pairs if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert abs(auc - wins / (len(pos) * len(neg))) < 1e-12


def test_bootstrap_independent_of_partitioning(spark):
    base = spark.createDataFrame(
        [("A", i, i % 3 == 0, float(i % 4 == 0)) for i in range(3000)], "model string, transaction_id long, tx_fraud boolean, prediction double"
    ).withColumn("tx_fraud", F.col("tx_fraud").cast("int"))
    a = {(r["replicate"], r["tp"], r["fp"], r["fn"]) for r in sampling.bootstrap_f1(base.repartition(1), 10, by=["model"]).collect()}
    b = {(r["replicate"], r["tp"], r["fp"], r["fn"]) for r in sampling.bootstrap_f1(base.repartition(7), 10, by=["model"]).collect()}
    assert a == b


def test_staged_clean_equals_lazy_clean(spark):
    rows = [row(i, float(i % 37) + (500.0 if i % 97 == 0 else 0.0), customer=(-999999 if i % 50 == 0 else i % 9)) for i in range(2000)]
    rows += rows[:100]
    df = tx_rows(spark, rows)
    lazy = {tuple(r) for r in cl.clean(df).collect()}
    staged = {tuple(r) for r in cl.clean(df, stage_path=scratch_path(spark, "t-stage")).collect()}
    assert lazy == staged and len(lazy) > 0


def test_verdict_sets_checkpoint_dir(spark):
    samples = spark.createDataFrame(
        [("A", i, 0.2 + 0.001 * i) for i in range(20)] + [("B", i, 0.4 + 0.001 * i) for i in range(20)], "model string, replicate int, f1 double"
    )
    r = abtest.ab_verdict(samples).first()
    assert r["verdict"] == "B better" and spark.sparkContext.getCheckpointDir()
