"""Math that Spark SQL lacks as a built-in, written as plain column arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ten-term Chebyshev fit of erfc from Numerical Recipes
# ("erfcc"), constant term first. Fractional error below 1.2e-7 everywhere.
ERFC_COEF = [
    -1.26551223,
    1.00002368,
    0.37409196,
    0.09678418,
    -0.18628806,
    0.27886807,
    -1.13520398,
    1.48851587,
    -0.82215223,
    0.17087277,
]


def _horner(t, coefs):
    acc = coefs[-1]
    for c in reversed(coefs[:-1]):
        acc = c + t * acc
    return acc


def erfc(x: Column) -> Column:
    """Complementary error function of a double column."""
    z = F.abs(x)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.5) * z)
    poly = _horner(t, [F.lit(c) for c in ERFC_COEF])
    ans = t * F.exp(-z * z + poly)
    return F.when(x >= 0, ans).otherwise(F.lit(2.0) - ans)


def erfc_py(x: float) -> float:
    z = abs(x)
    t = 1.0 / (1.0 + 0.5 * z)
    ans = t * math.exp(-z * z + _horner(t, ERFC_COEF))
    return ans if x >= 0 else 2.0 - ans


def normal_two_sided_p(z: Column) -> Column:
    """Two-sided normal tail probability for a statistic z, capped at 1; NULL for a NULL z."""
    return F.when(z.isNotNull(), F.least(F.lit(1.0), erfc(z / F.lit(math.sqrt(2.0)))))


def log_gamma(x: Column) -> Column:
    """Logarithm of the gamma function for a double column above 0: Stirling's series after
    moving the argument up by eight (relative error about 1e-15)."""
    moved = x + F.lit(8.0)
    product = x
    for i in range(1, 8):
        product = product * (x + F.lit(float(i)))
    inv = F.lit(1.0) / moved
    sq = inv * inv
    # B(2k) / (2k (2k - 1)) of Stirling's series.
    series = inv * _horner(sq, [F.lit(c) for c in (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360)])
    value = (moved - F.lit(0.5)) * F.log(moved) - moved + F.lit(0.5 * math.log(2.0 * math.pi)) + series
    # the product of eight factors would overflow only beyond 1e38
    return F.when(x > F.lit(1e15), (x - F.lit(0.5)) * F.log(x) - x + F.lit(0.5 * math.log(2.0 * math.pi))).otherwise(value - F.log(product))


def sign_test_p(b: Column, c: Column) -> Column:
    """Exact two-sided p value of b against c successes under equal chances:
    2 P(X <= min(b, c)) for X binomial(b + c, 1/2), at most 1; 1 where both are 0.

    The sum runs down from its greatest term, each term from the one before; terms further
    than 12 standard deviations below the mean are under 1e-30 of it and are left out.
    """
    n, k = (b + c).cast("double"), F.least(b, c)
    low = k.cast("double")
    top = F.exp(log_gamma(n + 1.0) - log_gamma(low + 1.0) - log_gamma(n - low + 1.0) - n * F.lit(math.log(2.0)))
    steps = F.least(k, F.ceil(F.lit(12.0) * F.sqrt(n)) + F.lit(60)).cast("long")
    start = F.struct(top.alias("term"), top.alias("total"))

    def step(s: Column, j: Column) -> Column:
        at = low - j.cast("double")  # from C(n, at + 1) to C(n, at)
        term = s["term"] * (at + 1.0) / (n - at)
        return F.struct(term.alias("term"), (s["total"] + term).alias("total"))

    offsets = F.when(steps > 0, F.sequence(F.lit(1).cast("long"), F.greatest(steps, F.lit(1)))).otherwise(F.array().cast("array<bigint>"))
    return F.least(F.lit(1.0), F.lit(2.0) * F.aggregate(offsets, start, step, lambda s: s["total"]))
