"""Repeatable pseudo-random numbers derived from a key.

``randomSplit`` and ``sample`` depend on how rows are partitioned, so the same
seed can give different rows on a different cluster layout. A value derived
from the row key alone is the same on every layout, on re-execution after an
executor loss, and in any other SQL engine that has md5.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_uniform(key: Column | str, seed: int | str = 42, salt: Column | str | None = None) -> Column:
    """A number in [0, 1) from the first 32 bits of md5('seed:' [|| salt || ':'] || key)."""
    key = F.col(key) if isinstance(key, str) else key
    parts = [F.lit(f"{seed}:")]
    if salt is not None:
        salt = F.col(salt) if isinstance(salt, str) else salt
        parts += [salt.cast("string"), F.lit(":")]
    parts.append(key.cast("string"))
    digest = F.md5(F.concat(*parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


# An md5 digest is 32 hex digits: four independent 32-bit lanes per hash.
LANES = 4


def hash_uniform_lanes(key: Column | str, seed: int | str = 42, salt: Column | str | None = None) -> list[Column]:
    """``LANES`` numbers in [0, 1) from one md5('seed:' [|| salt || ':'] || key):
    lane j is hex digits 8j+1 .. 8j+8. Lane 0 equals ``hash_uniform``."""
    key = F.col(key) if isinstance(key, str) else key
    parts = [F.lit(f"{seed}:")]
    if salt is not None:
        salt = F.col(salt) if isinstance(salt, str) else salt
        parts += [salt.cast("string"), F.lit(":")]
    parts.append(key.cast("string"))
    digest = F.md5(F.concat(*parts))
    return [F.conv(F.substring(digest, 8 * j + 1, 8), 16, 10).cast("double") / F.lit(4294967296.0) for j in range(LANES)]


def cdf_points(rate: float) -> list[float]:
    """Cumulative Poisson(rate) probabilities P(X <= 0), P(X <= 1), ... as far as a 32-bit
    uniform can reach (its largest value is 1 - 2**-32), each rounded to 12 places."""
    p = math.exp(-rate)
    if p <= 0.0 or rate < 0:
        raise ValueError(f"rate {rate} is out of range: exp(-rate) must be positive")
    out, acc, k = [], 0.0, 0
    while True:
        acc += p
        if round(acc, 12) > 1.0 - 2.0**-32:
            return out
        out.append(round(acc, 12))
        k += 1
        p *= rate / k
        if p == 0.0:  # no further mass in double precision
            return out


def poisson_weight(u: Column, rate: float = 0.8) -> Column:
    """Inverse-CDF Poisson draw from a uniform column: how many CDF points u reaches."""
    total = F.lit(0)
    for c in cdf_points(rate):
        total = total + (u >= F.lit(float(c))).cast("int")
    return total


#: Means from which a Poisson draw is taken from the normal form. Below, the distribution
#: function is summed up; POISSON_TERMS terms leave less than 1e-16 beyond them.
LARGE_MEAN = 64.0
POISSON_TERMS = 200


def poisson_draw(mean: Column, u: Column, u2: Column) -> Column:
    """A Poisson draw of any mean (a double column, not negative) from two uniforms in [0, 1).

    Small means: the smallest k whose distribution function exceeds ``u``, summed term by term.
    Large means: mean + sqrt(mean) z + (z^2 - 1) / 6, rounded, with z normal from both uniforms
    (the first terms of the Poisson quantile's expansion; what is left is below 0.1 counts).
    """
    start = F.struct(F.lit(0).cast("long").alias("k"), F.exp(-mean).alias("p"), F.exp(-mean).alias("cdf"))

    def step(s: Column, j: Column) -> Column:
        p = s["p"] * mean / j.cast("double")
        more = s["cdf"] <= u
        return F.struct(F.when(more, s["k"] + 1).otherwise(s["k"]).alias("k"), p.alias("p"), F.when(more, s["cdf"] + p).otherwise(s["cdf"]).alias("cdf"))

    small = F.aggregate(F.sequence(F.lit(1), F.lit(POISSON_TERMS)), start, step, lambda s: s["k"])
    half = F.lit(0.5 / 4294967296.0)  # the middle of a 32-bit step, so the logarithm is finite
    z = F.sqrt(F.lit(-2.0) * F.log(u + half)) * F.cos(F.lit(2.0 * math.pi) * u2)
    large = F.floor(mean + F.sqrt(mean) * z + (z * z - F.lit(1.0)) / F.lit(6.0) + F.lit(0.5))
    return F.when(mean < F.lit(LARGE_MEAN), small).otherwise(F.greatest(large, F.lit(0))).cast("long")
