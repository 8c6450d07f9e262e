import math
import random

import pytest

from pyspark.sql import functions as F

from txsentry.functions.hashing import cdf_points
from txsentry.functions.mathx import erfc, erfc_py
from txsentry.operators import abtest, sampling


def samples(spark, a, b):
    rows = [("A", i, float(v) if v is not None else None) for i, v in enumerate(a)]
    rows += [("B", i, float(v) if v is not None else None) for i, v in enumerate(b)]
    return spark.createDataFrame(rows, "model string, replicate int, f1 double")


def mwu_reference(a, b):
    """Plain-Python rank-sum test (midranks, tie and continuity correction)."""
    pooled = sorted([(v, 0) for v in a] + [(v, 1) for v in b])
    ranks, i = {}, 0
    while i < len(pooled):
        j = i
        while j < len(pooled) and pooled[j][0] == pooled[i][0]:
            j += 1
        ranks[pooled[i][0]] = (i + 1 + j) / 2.0
        i = j
    n1, n2 = len(a), len(b)
    n = n1 + n2
    r1 = sum(ranks[v] for v in a)
    u1 = r1 - n1 * (n1 + 1) / 2
    u2 = n1 * n2 - u1
    counts = {}
    for v, _ in pooled:
        counts[v] = counts.get(v, 0) + 1
    ties = sum(t**3 - t for t in counts.values())
    s = math.sqrt(n1 * n2 / 12 * ((n + 1) - ties / (n * (n - 1))))
    z = (max(u1, u2) - n1 * n2 / 2 - 0.5) / s
    return u1, u2, min(1.0, math.erfc(z / math.sqrt(2)))


def test_ties_fixture(spark):
    a, b = [1, 1, 2, 3], [1, 2, 2, 4]
    r = abtest.mann_whitney(samples(spark, a, b)).first()
    assert (r["u1"], r["u2"]) == (6.0, 10.0)
    _, _, p = mwu_reference(a, b)
    assert abs(r["p_value"] - p) < 1e-6


def test_u_sum_and_brute_force_pairs(spark):
    rnd = random.Random(1)
    a = [round(rnd.gauss(0.3, 0.02), 3) for _ in range(50)]
    b = [round(rnd.gauss(0.31, 0.02), 3) for _ in range(50)]
    r = abtest.mann_whitney(samples(spark, a, b), partitions=4).first()
    pairs = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    assert abs(r["u1"] - pairs) < 1e-9
    assert abs(r["u1"] + r["u2"] - 50 * 50) < 1e-9
    u1, u2, p = mwu_reference(a, b)
    assert abs(r["p_value"] - p) < 1e-6


def test_undefined_samples_are_counted_not_ranked(spark):
    df = samples(spark, [0.1, None, 0.3], [0.2, 0.4, None])
    iv = {r["model"]: r for r in abtest.f1_interval(df).collect()}
    assert iv["A"]["n_undefined"] == 1 and iv["A"]["n_defined"] == 2
    assert abtest.mann_whitney(df).first()["n1"] == 2


def test_interval_population_std(spark):
    df = samples(spark, [1, 2, 3, 4], [10, 10, 10, 10])
    iv = {r["model"]: r for r in abtest.f1_interval(df).collect()}
    std = math.sqrt(sum((x - 2.5) ** 2 for x in [1, 2, 3, 4]) / 4)
    assert abs(iv["A"]["std"] - std) < 1e-12 and abs(iv["A"]["lo"] - (2.5 - 3 * std)) < 1e-12


def test_verdict(spark):
    v = abtest.ab_verdict(samples(spark, [0.1, 0.11, 0.12, 0.1] * 5, [0.5, 0.51, 0.52, 0.5] * 5)).first()
    assert v["verdict"] == "B better" and v["same_distribution"] is False
    v = abtest.ab_verdict(samples(spark, [0.5, 0.51, 0.52, 0.5] * 5, [0.1, 0.11, 0.12, 0.1] * 5)).first()
    assert v["verdict"] == "A better"
    v = abtest.ab_verdict(samples(spark, [0.1, 0.5, 0.3, 0.2] * 5, [0.1, 0.5, 0.3, 0.2] * 5)).first()
    assert v["verdict"] == "undecided" and v["same_distribution"] is True


def test_undefined_side_is_not_called_the_same(spark):
    v = abtest.ab_verdict(samples(spark, [0.1, 0.2, 0.3], [None, None, None])).first()
    assert v["p_value"] is None and v["same_distribution"] is None
    assert (v["verdict"], v["n_undefined_b"]) == ("undefined", 3)
    same = abtest.ab_verdict(samples(spark, [0.2] * 5, [0.2] * 5)).first()
    assert same["p_value"] is None and same["same_distribution"] is None and same["verdict"] == "undecided"


def test_erfc_column_accuracy(spark):
    xs = [x / 10 for x in range(-50, 51)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(erfc(F.col("x"))).collect()]
    for x, g in zip(xs, got):
        assert abs(g - math.erfc(x)) < 2e-7
        assert abs(g - erfc_py(x)) < 1e-12


def test_poisson_constants():
    """All points that a 32-bit uniform can reach, and no more."""
    for rate in (0.8, 0.01, 5.0, 40.0):
        points = cdf_points(rate)
        p, acc = math.exp(-rate), 0.0
        for k, c in enumerate(points):
            acc += p
            assert abs(c - acc) < 1e-11
            p *= rate / (k + 1)
        assert points[-1] <= 1 - 2.0**-32 < acc + p + 1e-12
    assert len(cdf_points(0.8)) == 11
    for bad in (800.0, -1.0):
        with pytest.raises(ValueError):
            cdf_points(bad)


def pred_frame(spark, n=3000):
    rnd = random.Random(9)
    rows = []
    for i in range(n):
        y = int(rnd.random() < 0.2)
        p = float(y if rnd.random() < 0.7 else 1 - y)
        rows.append(("A", i, y, p))
        rows.append(("B", i, y, float(rnd.random() < 0.2)))
    return spark.createDataFrame(rows, "model string, transaction_id long, tx_fraud int, prediction double")


def test_bootstrap_repeatable_and_sized(spark):
    df = pred_frame(spark)
    a = sorted(tuple(r) for r in sampling.bootstrap_f1(df, 20, 0.8, by=["model"]).collect())
    b = sorted(tuple(r) for r in sampling.bootstrap_f1(df.repartition(7), 20, 0.8, by=["model"]).collect())
    assert a == b
    cells = sampling.bootstrap_cells(df, 20, 0.8, by=["model"]).collect()
    for c in cells:
        assert c["tp"] + c["tn"] + c["fp"] + c["fn"] == c["n"]
    mean_n = sum(c["n"] for c in cells) / len(cells)
    assert abs(mean_n - 0.8 * 3000) < 0.02 * 3000


def test_split_independent_of_partitioning(spark):
    df = spark.range(5000).withColumnRenamed("id", "transaction_id")
    one = [sorted(r[0] for r in p.collect()) for p in sampling.split_hash(df.repartition(1), [0.9, 0.1])]
    many = [sorted(r[0] for r in p.collect()) for p in sampling.split_hash(df.repartition(9), [0.9, 0.1])]
    assert one == many
    assert len(one[0]) + len(one[1]) == 5000 and not set(one[0]) & set(one[1])
    assert abs(len(one[1]) - 500) < 80


def test_paired_cells(spark):
    df = spark.createDataFrame([(1, 1.0, 0.0), (0, 0.0, 0.0), (1, 0.0, 1.0), (0, 1.0, 1.0)], "tx_fraud int, prediction_a double, prediction_b double")
    r = abtest.ab_paired(df).first()
    assert (r["both_right"], r["only_a_right"], r["only_b_right"], r["both_wrong"], r["n_disagree"]) == (1, 1, 1, 1, 2)
