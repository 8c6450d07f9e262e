"""Exact quantiles by bracketed selection: no sort and no shuffle of the values.

A quantile is the value at an exact rank. Each round one KLL sketch of the values that are
still open gives two pivots just below and above that rank. One pass counts the values
between, at and beyond the pivots, which tells exactly in which of these segments the rank
lies, and sketches the middle one for the next round. So a wrong pivot costs a round, never
the result; a value that fills a whole segment is found by its own count. Once at most
``limit`` values are open they are sorted inside one aggregate.

Every pass is one global aggregate: a task ships one row of counts and sketches, whatever the
size of the data. Each round keeps some three ``GRID``ths of the open values, so 10^11 rows take
five rounds.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SKETCH_K = 1024  # rank error about 0.3 %
GRID = 128  # a sketch comes to the driver as so many of its quantiles, and the least value
LIMIT = 1 << 16  # open values that are sorted in one aggregate

_DOUBLE = (F.kll_sketch_agg_double, F.kll_sketch_get_quantile_double)
_WHOLE = (F.kll_sketch_agg_bigint, F.kll_sketch_get_quantile_bigint)


@dataclass
class _Open:
    """A rank that is searched among the values above ``low`` and below ``high`` (None: no
    bound): ``below`` values lie at or under ``low``, ``inside`` between."""

    rank: int
    inside: int
    below: int = 0
    low: object = None
    high: object = None
    grid: list | None = None  # quantiles of the values inside, None where not sketched
    value: object = None
    done: bool = False


def _between(v: Column, low, high) -> Column:
    cond = v.isNotNull()
    if low is not None:
        cond = cond & (v > F.lit(low))
    if high is not None:
        cond = cond & (v < F.lit(high))
    return cond


def _around(grid: list, share: float) -> tuple:
    """The grid's values just below and above a share."""
    at = min(1.0, max(0.0, share)) * GRID
    return grid[max(0, math.floor(at) - 1)], grid[min(GRID, math.ceil(at) + 1)]


def supported(kind: T.DataType) -> bool:
    return isinstance(kind, (T.IntegralType, T.FloatType, T.DoubleType))


def select_ranks(df: DataFrame, col: str, probs: list[float], limit: int = LIMIT) -> list:
    """For each share p the smallest value whose cumulative share reaches p, None where the
    column has no value. NULLs do not count; NaN is the greatest value. ``df`` is read once a
    round, so it should be a table or file, not a costly plan."""
    kind = df.schema[col].dataType
    if not supported(kind):
        raise TypeError(f"{col}: no sketch for {kind.simpleString()}")
    build, quantile = _WHOLE if isinstance(kind, T.IntegralType) else _DOUBLE
    wide = "bigint" if isinstance(kind, T.IntegralType) else "double"
    values = df.select(F.col(col).cast(wide).alias("v")).filter("v is not null")
    v = F.col("v")

    shares = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])

    def grid(inside: Column) -> Column:
        """The sketch's quantiles of the values inside; NULL if it holds none."""
        number = inside if wide == "bigint" else inside & ~F.isnan(v)  # no sketch holds NaN
        return F.when(F.count_if(number) > 0, quantile(build(F.when(number, v), F.lit(SKETCH_K)), shares))

    n, whole = values.agg(F.count(F.lit(1)), grid(F.lit(True))).first()
    if n == 0:
        return [None] * len(probs)
    ranks = [_Open(min(n, max(1, math.ceil(float(p) * n))), n, grid=whole) for p in probs]
    while True:
        wide_open = [(i, r) for i, r in enumerate(ranks) if not r.done and r.inside > limit]
        if not wide_open:
            break
        aggs, cuts = [], {}
        for i, r in wide_open:
            inside = _between(v, r.low, r.high)
            if r.grid is None:  # the segment has no sketch yet
                aggs.append(grid(inside).alias(f"grid{i}"))
                continue
            a, b = cuts[i] = _around(r.grid, (r.rank - r.below) / r.inside)
            middle = _between(v, a, b)
            counts = [F.count_if(s) for s in (inside & (v < a), v == a, middle, (v == b) & F.lit(a != b), inside & (v > b))]
            aggs += [*[c.alias(f"n{i}_{k}") for k, c in enumerate(counts)], grid(middle).alias(f"grid{i}")]
        row = values.agg(*aggs).first()
        for i, r in wide_open:
            if i not in cuts:
                r.grid = row[f"grid{i}"]
                if r.grid is None:  # only NaN is left
                    r.value, r.done = float("nan"), True
                continue
            a, b = cuts[i]
            for k, place in enumerate([(r.low, a), a, (a, b), b, (b, r.high)]):
                count = row[f"n{i}_{k}"]
                if r.rank <= r.below + count:
                    if isinstance(place, tuple):
                        (r.low, r.high), r.inside = place, count
                        r.grid = row[f"grid{i}"] if k == 2 else None
                    else:
                        r.value, r.done = place, True
                    break
                r.below += count
    rest = [(i, r) for i, r in enumerate(ranks) if not r.done]
    if rest:
        # at most ``limit`` values each
        row = values.agg(*[F.get(F.sort_array(F.collect_list(F.when(_between(v, r.low, r.high), v))), F.lit(r.rank - r.below - 1)).alias(f"v{i}") for i, r in rest]).first()
        for i, r in rest:
            r.value = row[f"v{i}"]
    return [r.value for r in ranks]


def selected_quantiles(df: DataFrame, col: str, probs: list[float], limit: int = LIMIT) -> DataFrame:
    """One row with ``q<i>`` per share, in the column's type."""
    kind = df.schema[col].dataType
    found = select_ranks(df, col, probs, limit)
    row = df.sparkSession.range(1)
    return row.select(*[F.lit(x).cast(kind).alias(f"q{i}") for i, x in enumerate(found)])
