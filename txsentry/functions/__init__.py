"""Column expressions shared by the operators. All of them are built-in Spark
expressions, so they stay inside whole-stage codegen."""

from txsentry.functions.hashing import cdf_points, hash_uniform, poisson_weight
from txsentry.functions.mathx import erfc, normal_two_sided_p
from txsentry.functions.timefeat import seconds_of_day, time_parts_cols, parse_ts

__all__ = [
    "hash_uniform",
    "poisson_weight",
    "cdf_points",
    "erfc",
    "normal_two_sided_p",
    "seconds_of_day",
    "time_parts_cols",
    "parse_ts",
]
