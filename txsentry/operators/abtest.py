"""A/B comparison of two models from their bootstrap metric samples.

All results are lazy one-row (or one-row-per-model) frames: the 3-sigma
interval, the Mann-Whitney rank-sum test and the verdict. Undefined samples
(NULL F1) are counted and left out, never turned into errors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txsentry.functions.mathx import normal_two_sided_p, sign_test_p
from txsentry.operators.ranking import running_totals
from txsentry.session import scratch_dir


def f1_interval(samples: DataFrame, value: str = "f1", by: str = "model", k: float = 3.0) -> DataFrame:
    """Mean +/- k population standard deviations per model (the numpy default ddof=0)."""
    x = F.col(value).cast("double")
    g = samples.groupBy(by).agg(
        F.avg(x).alias("mean"),
        F.stddev_pop(x).alias("std"),
        F.count(x).alias("n_defined"),
        F.count_if(x.isNull()).alias("n_undefined"),
    )
    return g.select(
        by,
        "mean",
        "std",
        (F.col("mean") - F.lit(k) * F.col("std")).alias("lo"),
        (F.col("mean") + F.lit(k) * F.col("std")).alias("hi"),
        "n_defined",
        "n_undefined",
    )


def mann_whitney(samples: DataFrame, value: str = "f1", by: str = "model", a: str = "A", b: str = "B", partitions: int | None = None, p_method: str = "asymptotic") -> DataFrame:
    """Two-sided Mann-Whitney U test of sample ``a`` against sample ``b``.

    Midranks over the pooled sample come from distributed running counts of
    distinct values (so it scales to raw score columns, not only to bootstrap
    samples). Reports U1 (of ``a``), U2, the normal statistic with continuity
    correction and tie correction, and its two-sided p value. ``p_method`` decides which p
    value, whatever the sample size: "asymptotic" from the normal statistic, "exact" from
    the null distribution of U, which has no ties (NULL where there are some, and where
    n1 * n2 exceeds EXACT_PAIRS). Both are NULL (the test is undefined) when a side has no
    defined value; the asymptotic one also when all pooled values are equal.
    """
    if p_method not in ("asymptotic", "exact"):
        raise ValueError(f"unknown p_method {p_method!r}")
    x = F.col(value).cast("double")
    s = samples.filter(x.isNotNull() & F.col(by).isin(a, b))
    is_a = (F.col(by) == F.lit(a)).cast("long")
    vc = s.groupBy(x.alias("v")).agg(F.count(F.lit(1)).alias("n"), F.sum(is_a).alias("n_a"))
    cum = running_totals(vc, "v", ["n"], partitions=partitions)
    midrank = (F.col("cum_n") - F.col("n")).cast("double") + (F.col("n").cast("double") + F.lit(1.0)) / F.lit(2.0)
    t = F.col("n").cast("double")
    one = cum.agg(
        F.sum(F.col("n_a").cast("double") * midrank).alias("r1"),
        F.sum(F.col("n_a")).cast("double").alias("n1"),
        F.sum(F.col("n") - F.col("n_a")).cast("double").alias("n2"),
        F.sum(t * t * t - t).alias("ties"),
    )
    n1, n2 = F.col("n1"), F.col("n2")
    n = n1 + n2
    u1 = F.col("r1") - n1 * (n1 + F.lit(1.0)) / F.lit(2.0)
    one = one.select("n1", "n2", "ties", u1.alias("u1"), (n1 * n2 - u1).alias("u2"))
    mu = n1 * n2 / F.lit(2.0)
    var = n1 * n2 / F.lit(12.0) * ((n + F.lit(1.0)) - F.try_divide(F.col("ties"), n * (n - F.lit(1.0))))
    sd = F.sqrt(var)
    z = F.try_divide(F.greatest(F.col("u1"), F.col("u2")) - mu - F.lit(0.5), F.when(sd > 0, sd))
    if p_method == "exact":
        can = (n1 > 0) & (n2 > 0) & (F.col("ties") == 0) & (n1 * n2 <= F.lit(float(EXACT_PAIRS)))
        p = F.when(can, exact_u_p(n1.cast("int"), n2.cast("int"), F.greatest(F.col("u1"), F.col("u2")).cast("int")))
    else:
        p = normal_two_sided_p(z)
    return one.select(
        F.col("n1").cast("bigint").alias("n1"),
        F.col("n2").cast("bigint").alias("n2"),
        "u1",
        "u2",
        z.alias("z"),
        p.alias("p_value"),
    )


#: The exact test's work grows with the square of n1 * n2.
EXACT_PAIRS = 4096


def exact_u_p(n1: Column, n2: Column, u: Column) -> Column:
    """2 P(U >= u) under the null hypothesis without ties, at most 1.

    The number of arrangements with statistic u follows f(m, n, u) = f(m - 1, n, u - n) +
    f(m, n - 1, u). For n = 0, 1, ..., n2 a list over m = 0 ... n1 of arrays over u is
    carried on; all terms are positive, so doubles lose nothing to cancellation.
    """
    last = n1 * n2
    zero = F.transform(F.sequence(F.lit(0), last), lambda x: F.when(x == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    start = F.array_repeat(zero, n1 + 1)

    def next_n(old: Column, n: Column) -> Column:
        def next_m(new: Column, m: Column) -> Column:
            before, same = F.get(new, m - 1), F.get(old, m)
            return F.concat(new, F.array(F.transform(same, lambda x, v: x + F.when(v >= n, F.get(before, v - n)).otherwise(F.lit(0.0)))))

        return F.aggregate(F.sequence(F.lit(1), n1), F.array(zero), next_m)

    ways = F.get(F.aggregate(F.sequence(F.lit(1), n2), start, next_n), n1)
    total = F.aggregate(ways, F.lit(0.0), lambda s, x: s + x)
    tail = F.aggregate(F.slice(ways, u + 1, last - u + 1), F.lit(0.0), lambda s, x: s + x)
    return F.least(F.lit(1.0), F.lit(2.0) * tail / total)


def ab_verdict(
    samples: DataFrame, value: str = "f1", by: str = "model", a: str = "A", b: str = "B", alpha: float = 0.05, k: float = 3.0, materialize: bool = True
) -> DataFrame:
    """One row: the test (U1, p), whether the distributions differ at ``alpha``,
    both intervals, and which model is better when the intervals do not overlap. A
    model without any defined sample has no interval: the test's columns and
    ``same_distribution`` are NULL and the verdict is ``undefined``.

    The sample table is read three times (test, two intervals); it has one row per
    model and replicate, so it is checkpointed to the shared checkpoint folder
    first (``materialize``) instead of recomputing the scoring behind it.
    """
    if materialize:
        scratch_dir(samples.sparkSession)  # the shared checkpoint folder is set
        samples = samples.checkpoint(eager=True)
    test = mann_whitney(samples, value, by, a, b)
    iv = f1_interval(samples, value, by, k)
    ia = iv.filter(F.col(by) == F.lit(a)).select(*[F.col(c).alias(f"{c}_a") for c in ("mean", "lo", "hi", "n_undefined")])
    ib = iv.filter(F.col(by) == F.lit(b)).select(*[F.col(c).alias(f"{c}_b") for c in ("mean", "lo", "hi", "n_undefined")])
    row = test.select(
        "u1",
        "p_value",
        *[ia.select(c).scalar().alias(c) for c in ia.columns],
        *[ib.select(c).scalar().alias(c) for c in ib.columns],
    )
    same = F.col("p_value") > F.lit(alpha)
    verdict = (
        F.when(F.col("mean_a").isNull() | F.col("mean_b").isNull(), F.lit("undefined"))
        .when(F.col("hi_a") < F.col("lo_b"), F.lit("B better"))
        .when(F.col("hi_b") < F.col("lo_a"), F.lit("A better"))
        .otherwise(F.lit("undecided"))
    )
    return row.select(
        "u1",
        "p_value",
        same.alias("same_distribution"),
        "mean_a",
        "lo_a",
        "hi_a",
        "mean_b",
        "lo_b",
        "hi_b",
        "n_undefined_a",
        "n_undefined_b",
        verdict.alias("verdict"),
    )


def ab_paired(scored: DataFrame, label: str = "tx_fraud", pred_a: str = "prediction_a", pred_b: str = "prediction_b") -> DataFrame:
    """Both models on the same rows, one pass: where they agree and disagree with
    the label. The two predictions sit side by side in one table (the second
    model transforms the first one's output), so no join is needed."""
    y = F.col(label) == 1
    ca = (F.col(pred_a) == 1) == y
    cb = (F.col(pred_b) == 1) == y
    return scored.agg(
        F.count_if(ca & cb).alias("both_right"),
        F.count_if(ca & ~cb).alias("only_a_right"),
        F.count_if(~ca & cb).alias("only_b_right"),
        F.count_if(~ca & ~cb).alias("both_wrong"),
        F.count_if(F.col(pred_a) != F.col(pred_b)).alias("n_disagree"),
    )


def mcnemar(scored: DataFrame, label: str = "tx_fraud", pred_a: str = "prediction_a", pred_b: str = "prediction_b") -> DataFrame:
    """McNemar's test of two models on the same rows, one pass: one row with the numbers of
    rows that only one model gets right, the exact two-sided p value (a sign test on them), the
    continuity-corrected statistic and its asymptotic p value. Without any such row the exact
    p is 1 and the statistic undefined (NULL). Rows with a NULL count for neither."""
    pair = ab_paired(scored.filter(F.col(label).isNotNull() & F.col(pred_a).isNotNull() & F.col(pred_b).isNotNull()), label, pred_a, pred_b)
    b, c = F.col("only_a_right"), F.col("only_b_right")
    away = F.greatest(F.abs(b - c).cast("double") - F.lit(1.0), F.lit(0.0))
    statistic = F.try_divide(away * away, (b + c).cast("double"))
    return pair.select(b, c, sign_test_p(b, c).alias("p_exact"), statistic.alias("statistic"), normal_two_sided_p(F.sqrt(statistic)).alias("p_asymptotic"))
