"""Cleaning operators for the raw transaction table: full-row dedup, key checks,
fill, exact or approximate quantiles and the upper IQR fence.

Exact quantiles are found by bracketed selection: a few global aggregates at once, whose
counts and pivots (a handful of numbers) come to the driver. With ``stage_path`` the
deduplicated rows are written once, at once; the rest stays lazy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txsentry.operators import selection
from txsentry.operators.ranking import running_totals, value_counts
from txsentry.session import scratch_path
from txsentry.sources.files import materialize

# Fixed value: the "unknown customer" id of the raw feed.
SENTINEL_CUSTOMER = -999999


def dedup_rows(df: DataFrame) -> DataFrame:
    """Drop rows that repeat on every column. Hash-partitioned on all columns; the
    map-side partial aggregate removes repeats before the shuffle."""
    return df.dropDuplicates()


def filter_sentinel(df: DataFrame, col: str = "customer_id", sentinel: int = SENTINEL_CUSTOMER) -> DataFrame:
    """Keep rows whose key differs from the sentinel. A NULL key is dropped as well
    (``NULL != x`` is not true)."""
    return df.filter(F.col(col) != F.lit(sentinel))


def drop_null_key(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in any of ``cols``. Written as ``isNotNull`` so the test
    reaches the Parquet scan (``na.drop`` is not pushed down)."""
    cols = cols or ["terminal_id"]
    cond = None
    for c in cols:
        t = F.col(c).isNotNull()
        cond = t if cond is None else cond & t
    return df.filter(cond)


def fill_zero(df: DataFrame) -> DataFrame:
    """NULL -> 0 in numeric columns only; text and time columns keep their NULLs."""
    return df.fillna(0)


def quantiles(
    df: DataFrame,
    col: str,
    probs: list[float],
    method: str = "exact",
    rel_error: float = 0.05,
    partitions: int | None = None,
    staged: bool = False,
) -> DataFrame:
    """One row with ``q<i>`` per probability.

    exact: the smallest value whose cumulative share reaches p (``percentile_disc``), by
    bracketed selection (``operators.selection``): no shuffle of values, and no task holds
    many. Each round reads the column again, so it is written to the shared scratch folder
    first unless the caller says that ``df`` is ``staged`` (a table or file).
    ranks: the same by distributed running counts over the distinct values, for types
    without a sketch (decimals, dates), and where many probabilities are wanted.
    approx: Greenwald-Khanna summaries merged map-side (``percentile_approx``),
    accuracy 1 / rel_error.
    """
    names = [f"q{i}" for i in range(len(probs))]
    if method == "approx":
        acc = max(1, int(round(1.0 / rel_error)))
        arr = F.percentile_approx(F.col(col), F.array(*[F.lit(float(p)) for p in probs]), acc)
        return df.agg(arr.alias("_q")).select(*[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    if method not in ("exact", "ranks"):
        raise ValueError(f"unknown quantile method {method!r}")
    if method == "exact" and selection.supported(df.schema[col].dataType):
        values = df.select(col).filter(F.col(col).isNotNull())
        if not staged:
            values = materialize(values, scratch_path(df.sparkSession, "quantile-values"))
        return selection.selected_quantiles(values, col, probs)
    vc = value_counts(df.filter(F.col(col).isNotNull()), col, name="v")
    cum = running_totals(vc, "v", ["n"], partitions=partitions)
    return cum.agg(
        *[
            F.min(F.when(F.col("cum_n") >= F.ceil(F.lit(float(p)) * F.col("tot_n")), F.col("v"))).alias(n)
            for p, n in zip(probs, names)
        ]
    )


def iqr_fences(
    df: DataFrame,
    col: str = "tx_amount",
    k: float = 1.5,
    method: str = "exact",
    rel_error: float = 0.05,
    partitions: int | None = None,
    staged: bool = False,
) -> DataFrame:
    """One row: q1, q3, iqr, lower and upper fence (q -/+ k * iqr)."""
    q = quantiles(df, col, [0.25, 0.75], method=method, rel_error=rel_error, partitions=partitions, staged=staged)
    return fences_of(q.select(F.col("q0").alias("q1"), F.col("q1").alias("q3")), k)


def fences_of(quartiles: DataFrame, k: float = 1.5) -> DataFrame:
    """One row: the quartiles ``q1`` and ``q3`` with iqr, lower and upper fence."""
    q = quartiles.select(F.col("q1").cast("double").alias("q1"), F.col("q3").cast("double").alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    return q.select(
        "q1",
        "q3",
        iqr.alias("iqr"),
        (F.col("q1") - F.lit(k) * iqr).alias("lower_fence"),
        (F.col("q3") + F.lit(k) * iqr).alias("upper_fence"),
    )


def apply_upper_fence(df: DataFrame, col: str, fence: Column) -> DataFrame:
    """Keep rows at or below the fence; a NULL value is dropped."""
    return df.filter(F.col(col) <= fence)


def clean(
    df: DataFrame,
    sentinel: int = SENTINEL_CUSTOMER,
    key_cols: list[str] | None = None,
    amount_col: str = "tx_amount",
    k: float = 1.5,
    method: str = "exact",
    rel_error: float = 0.05,
    partitions: int | None = None,
    stage_path: str | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Dedup, drop sentinel / NULL keys, then cut amounts above the upper IQR fence
    computed on the filtered rows (the fence is upper-side only).

    ``stage_path``: write the deduplicated, key-checked rows there once (a folder
    under the shared ``spark.checkpoint.dir``) and read them back for both the
    fence and the filter. That costs one write but saves the second full-row
    shuffle (the fence branch then reads only the amount column) and cuts the
    lineage, so a lost executor does not re-run the dedup. Without it the plan
    stays one lazy query (the dedup is evaluated in both branches, the fence
    test is pushed into the scan of the main branch).

    ``keep``: the columns of the result. They are projected after the dedup (which
    needs all columns) and before the write, so only they and the amount are staged.
    """
    base = drop_null_key(filter_sentinel(dedup_rows(df), sentinel=sentinel), key_cols)
    if keep:
        base = base.select(*dict.fromkeys([*keep, amount_col]))
    if stage_path:
        base = materialize(base, stage_path)
    fences = iqr_fences(base, amount_col, k=k, method=method, rel_error=rel_error, partitions=partitions, staged=bool(stage_path))
    out = apply_upper_fence(base, amount_col, fences.select("upper_fence").scalar())
    return out.select(*keep) if keep else out
