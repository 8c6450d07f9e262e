"""Exact tests, Poisson draws, the cell bootstrap, stored sketches and the operating threshold."""

import itertools
import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from txsentry.functions.hashing import hash_uniform_lanes, poisson_draw
from txsentry.functions.mathx import log_gamma, sign_test_p
from txsentry.operators import abtest, metrics as me, sampling, sketches


def test_log_gamma(spark):
    xs = [1.0, 1.5, 2.0, 7.0, 30.5, 1000.0, 1e6, 1e12, 1e17]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(log_gamma(F.col("x"))).collect()]
    assert all(abs(g - math.lgamma(x)) <= 1e-13 * max(1.0, abs(math.lgamma(x))) for g, x in zip(got, xs))


def test_sign_test_against_fractions(spark):
    rows = [(b, c) for b in range(13) for c in range(13)] + [(40, 70), (500, 431), (3, 2000)]

    def exact(b, c):
        return float(min(Fraction(1), Fraction(2 * sum(math.comb(b + c, i) for i in range(min(b, c) + 1)), 2 ** (b + c))))

    got = spark.createDataFrame(rows, "b long, c long").select("b", "c", sign_test_p(F.col("b"), F.col("c")).alias("p")).collect()
    for r in got:
        assert abs(r.p - exact(r.b, r.c)) <= 1e-12 * max(1.0, 1.0) and math.isclose(r.p, exact(r.b, r.c), rel_tol=1e-10)
    far = spark.createDataFrame([(10**9, 10**9 + 60_000)], "b long, c long").select(sign_test_p(F.col("b"), F.col("c"))).first()[0]
    z = (60_000 - 1) / math.sqrt(2 * 10**9 + 60_000)
    assert math.isclose(far, math.erfc(z / math.sqrt(2)), rel_tol=1e-3)


def test_mcnemar_rows(spark):
    rows = [(1, 1, 0)] * 9 + [(0, 1, 0)] * 2 + [(1, 1, 1)] * 5 + [(None, 1, 0), (1, None, 0)]
    got = abtest.mcnemar(spark.createDataFrame(rows, "tx_fraud int, prediction_a int, prediction_b int")).first()
    assert (got.only_a_right, got.only_b_right) == (9, 2)
    assert math.isclose(got.p_exact, 2 * sum(math.comb(11, i) for i in range(3)) / 2**11)
    assert math.isclose(got.statistic, 36 / 11)
    none = abtest.mcnemar(spark.createDataFrame([(1, 1, 1)], "tx_fraud int, prediction_a int, prediction_b int")).first()
    assert (none.p_exact, none.statistic, none.p_asymptotic) == (1.0, None, None)


def test_exact_u_against_enumeration(spark):
    """All sizes up to 8, every reachable statistic at or above the middle."""
    rows, want = [], {}
    for n1, n2 in itertools.product(range(1, 9), repeat=2):
        if n1 * n2 > 40 and (n1, n2) != (8, 8):
            continue
        us = Counter(sum(a) - n1 * (n1 + 1) // 2 for a in itertools.combinations(range(1, n1 + n2 + 1), n1))
        total = math.comb(n1 + n2, n1)
        for u in range(-(-n1 * n2 // 2), n1 * n2 + 1):
            rows.append((n1, n2, u))
            want[n1, n2, u] = float(min(Fraction(1), Fraction(2 * sum(k for x, k in us.items() if x >= u), total)))
    got = spark.createDataFrame(rows, "a int, b int, u int").select("a", "b", "u", abtest.exact_u_p(F.col("a"), F.col("b"), F.col("u")).alias("p"))
    assert all(math.isclose(r.p, want[r.a, r.b, r.u], rel_tol=1e-12) for r in got.collect())


def test_mann_whitney_p_method(spark):
    rows = [("A", 1.0), ("A", 2.0), ("A", 3.5), ("B", 3.0), ("B", 4.0), ("B", 5.0), ("B", 6.0)]
    df = spark.createDataFrame(rows, "model string, f1 double")
    exact, normal = (abtest.mann_whitney(df, p_method=m).first() for m in ("exact", "asymptotic"))
    assert exact.u1 == normal.u1 == 1.0 and exact.z == normal.z
    assert math.isclose(exact.p_value, 4 / 35) and exact.p_value != normal.p_value
    tied = spark.createDataFrame([*rows, ("A", 3.0)], "model string, f1 double")
    assert abtest.mann_whitney(tied, p_method="exact").first().p_value is None
    assert abtest.mann_whitney(df.filter("model = 'A'"), p_method="exact").first().p_value is None
    with pytest.raises(ValueError):
        abtest.mann_whitney(df, p_method="auto")


def test_poisson_draws_of_any_mean(spark):
    u, u2, *_ = hash_uniform_lanes("id", 7)
    for mean in (0.0, 0.3, 5.0, 63.0, 64.0, 4000.0, 8e10):
        x = np.array([r[0] for r in spark.range(20000).select(poisson_draw(F.lit(mean), u, u2)).collect()], float)
        assert abs(x.mean() - mean) <= 4.5 * math.sqrt(mean / len(x)) + 1e-12
        if mean:
            assert abs(x.var() / mean - 1) < 0.06
    for mean in (2.0, 100.0):  # the whole distribution
        x = Counter(r[0] for r in spark.range(20000).select(poisson_draw(F.lit(mean), u, u2)).collect())
        gap, seen, cdf, p = 0.0, 0, 0.0, math.exp(-mean)
        for k in range(400):
            seen, cdf = seen + x[k], cdf + p
            p *= mean / (k + 1)
            gap = max(gap, abs(seen / 20000 - cdf))
        assert gap < 0.015


def test_cell_bootstrap_agrees_with_rows(spark):
    """Mean and spread of F1 over many replicates, both modes."""
    rng = random.Random(3)
    rows = [(i, int(rng.random() < 0.3), float(rng.random() < 0.4)) for i in range(1500)]
    df = spark.createDataFrame(rows, "transaction_id long, tx_fraud int, prediction double")
    a, b = (np.array([r.f1 for r in sampling.bootstrap_f1(df, 400, mode=m).collect()]) for m in ("rows", "cells"))
    assert len(a) == len(b) == 400
    assert abs(a.mean() - b.mean()) < 4 * a.std() / math.sqrt(200)
    assert 0.85 < b.std() / a.std() < 1.18
    again = sampling.bootstrap_f1(df.repartition(7), 400, mode="cells").collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, sampling.bootstrap_f1(df, 400, mode="cells").collect()))
    empty = sampling.bootstrap_f1(df.filter("prediction = 2"), 3, mode="cells").collect()
    assert [(r.n, r.f1) for r in empty] == [(0, None)] * 3
    with pytest.raises(ValueError):
        sampling.bootstrap_f1(df, 3, mode="other")


def test_merged_sketches_in_any_order(spark, tmp_path):
    rng = random.Random(8)
    rows = [(rng.randrange(9), rng.lognormvariate(3, 1)) for _ in range(30000)] + [(None, 5.0), (3, None), (3, float("nan"))]
    df = spark.createDataFrame(rows, "tx_time_days int, tx_amount double")
    path = str(tmp_path / "sketches")
    parts = df.randomSplit([0.2, 0.5, 0.3], 1)
    for order in ((0, 1, 2), (2, 0, 1), (1, 1, 2, 0)):  # a run that is repeated replaces itself
        for i in order:
            sketches.store(sketches.day_sketches(parts[i], "tx_amount"), path, f"r{i}")
        q = sketches.quantiles_from(sketches.stored(spark, path), [0.25, 0.5, 0.75]).first()
        values = np.sort([v for _, v in rows if v is not None and v == v])
        assert q.n == len(values)
        for p, x in zip((0.25, 0.5, 0.75), (q.q0, q.q1, q.q2)):
            assert abs(np.searchsorted(values, x) / len(values) - p) < 2 * sketches.RANK_ERROR
    days = sketches.merged(sketches.stored(spark, path), ["day"]).collect()
    assert {r.day for r in days} == {*range(9), None}
    some = sketches.quantiles_from(sketches.stored(spark, path).filter("day < 0"), [0.5]).first()
    assert (some.q0, some.n) == (None, 0)


def test_operating_threshold(spark):
    rng = random.Random(5)
    rows = [(int(rng.random() < 0.2), rng.random(), rng.choice([1.0, 2.5, None])) for _ in range(400)]
    rows = [(y, round(s * 0.3 + y * 0.6 + (0.3 if rng.random() < 0.02 else 0), 2), a) for y, s, a in rows] + [(None, 0.5, 1.0), (1, None, 1.0)]
    df = spark.createDataFrame(rows, "tx_fraud int, score double, tx_amount double")
    held = [r for r in rows if r[0] is not None and r[1] is not None]
    pos, neg = sum(r[0] for r in held), sum(1 - r[0] for r in held)
    for miss, declined in ((0.02, 0.05), (0.2, 0.01), (0.0, 0.0), (1.0, 1.0)):
        best = None
        for t in {r[1] for r in held}:
            tp, fp = sum(y for y, s, _ in held if s >= t), sum(1 - y for y, s, _ in held if s >= t)
            if tp and (pos - tp) / pos <= miss and fp / neg <= declined:
                missed = sum(a or 0 for y, s, a in held if y and s < t)
                best = max(best or (0,), (2 * tp / (2 * tp + fp + pos - tp), t, tp, fp, pos - tp, missed))
        got = me.operating_threshold(df, max_miss_rate=miss, max_false_decline_rate=declined).first()
        assert got.feasible == (best is not None) and (got.n_fraud, got.n_good) == (pos, neg)
        if best:
            assert math.isclose(got.f1, best[0]) and (got.threshold, got.tp, got.fp, got.fn) == best[1:5] and math.isclose(got.missed_amount, best[5])
        else:
            assert got.threshold is None and got.f1 is None
    empty = me.operating_threshold(df.filter("tx_fraud = 7")).first()
    assert (empty.feasible, empty.n_fraud, empty.n_good) == (False, 0, 0)
