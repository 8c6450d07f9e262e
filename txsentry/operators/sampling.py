"""Splits and bootstrap weights derived from the row key.

``split_hash`` replaces ``randomSplit``: the same rows land in the same part
whatever the partitioning, so a validation job can rebuild the training split.
``bootstrap_cells`` replaces R rounds of ``sample(withReplacement=True)`` with
one pass: each (row, replicate) gets a Poisson weight (Spark's own sampling with
replacement is Poisson per row as well), and the weighted confusion cells of all
replicates come out of one grouped aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txsentry.functions.hashing import LANES, hash_uniform, hash_uniform_lanes, poisson_draw, poisson_weight
from txsentry.operators.metrics import confusion, prf_cols


def split_label(key: Column | str, weights: list[float], names: list[str] | None = None, seed: int = 42) -> Column:
    """The part name of each row from a hash of its key and cumulative weights."""
    total = float(sum(weights))
    names = names or [str(i) for i in range(len(weights))]
    u = hash_uniform(key, seed)
    expr, acc = None, 0.0
    for w, n in zip(weights[:-1], names[:-1]):
        acc += w / total
        expr = F.when(u < F.lit(acc), F.lit(n)) if expr is None else expr.when(u < F.lit(acc), F.lit(n))
    last = F.lit(names[-1])
    return last if expr is None else expr.otherwise(last)


def split_hash(df: DataFrame, weights: list[float], key: str = "transaction_id", seed: int = 42) -> list[DataFrame]:
    """Disjoint, complete parts in proportion to ``weights``; a filter each, no shuffle."""
    names = [str(i) for i in range(len(weights))]
    lab = split_label(key, weights, names, seed)
    return [df.filter(lab == F.lit(n)) for n in names]


def bootstrap_cells(
    preds: DataFrame,
    replicates: int = 50,
    rate: float = 0.8,
    seed: int = 42,
    key: str = "transaction_id",
    label: str = "tx_fraud",
    pred: str = "prediction",
    by: list[str] | None = None,
    mode: str = "rows",
) -> DataFrame:
    """Weighted confusion cells per (group, replicate) for ``replicates`` resamples
    with replacement of expected size ``rate`` x rows.

    ``mode="cells"``: the weights of a cell's rows are independent Poisson draws, so their sum
    is one Poisson draw of mean ``rate`` x the cell's size. The rows are counted once (four
    numbers a group), and each (group, replicate, cell) takes one draw from
    md5('seed:' || group || ':' || replicate || ':' || cell): the cost of more replicates does
    not depend on the rows. ``mode="rows"`` draws per row, as follows.

    The draw for a row depends on (group, replicate, key) only, so it repeats on
    re-execution. Replicate r uses lane r mod 4 of md5('seed:' || group || ':' ||
    r div 4 || ':' || key), so one hash serves four replicates: rows fan out over
    blocks of four replicates, not over replicates. The fan-out happens inside the
    map stage and the aggregate is partial there, so each task ships at most
    groups x blocks rows, which are then unpivoted to one row per replicate.
    """
    by = list(by or [])
    if mode == "cells":
        return _draw_cells(confusion(preds, label, pred, by), replicates, rate, seed, by)
    if mode != "rows":
        raise ValueError(f"unknown bootstrap mode {mode!r}")
    blocks = -(-replicates // LANES)
    salt = F.concat_ws(":", *[F.col(b).cast("string") for b in by], F.col("_blk").cast("string"))
    y = F.col(label).cast("long")
    p = F.col(pred).cast("long")
    fan = preds.select(*by, key, y.alias("_y"), p.alias("_p"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_blk"))
    weights = [poisson_weight(u, rate).alias(f"_w{j}") for j, u in enumerate(hash_uniform_lanes(key, seed, salt=salt))]
    weighted = fan.select(*by, "_blk", "_y", "_p", *weights)
    yv, pv = F.col("_y"), F.col("_p")
    sums = []
    for j in range(LANES):
        w = F.col(f"_w{j}")
        sums += [
            F.sum(w * yv * pv).alias(f"tp{j}"),
            F.sum(w * (1 - yv) * (1 - pv)).alias(f"tn{j}"),
            F.sum(w * (1 - yv) * pv).alias(f"fp{j}"),
            F.sum(w * yv * (1 - pv)).alias(f"fn{j}"),
            F.sum(w).alias(f"n{j}"),
        ]
    per_block = weighted.groupBy(*by, "_blk").agg(*sums)
    lanes = F.array(
        *[
            F.struct(
                (F.col("_blk") * LANES + j).cast("int").alias("replicate"),
                *[F.col(f"{c}{j}").alias(c) for c in ("tp", "tn", "fp", "fn", "n")],
            )
            for j in range(LANES)
        ]
    )
    out = per_block.select(*by, F.inline(lanes))
    return out.filter(F.col("replicate") < F.lit(replicates))


CELLS = ["tp", "tn", "fp", "fn"]


def _draw_cells(cells: DataFrame, replicates: int, rate: float, seed: int, by: list[str]) -> DataFrame:
    """(group, replicate) with one Poisson draw per confusion cell; n is their sum."""
    fan = cells.select(*by, *CELLS, F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("replicate"))
    salt = F.concat_ws(":", *[F.col(b).cast("string") for b in by], F.col("replicate").cast("string"))
    draws = []
    for c in CELLS:
        u, u2, *_ = hash_uniform_lanes(F.lit(c), seed, salt=salt)
        draws.append(poisson_draw(F.col(c).cast("double") * F.lit(float(rate)), u, u2).alias(c))
    out = fan.select(*by, "replicate", *draws)
    return out.withColumn("n", F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn"))


def bootstrap_f1(preds: DataFrame, replicates: int = 50, rate: float = 0.8, seed: int = 42, by: list[str] | None = None, **kw) -> DataFrame:
    """(group, replicate, n, f1): the F1 sample of each group. F1 is NULL for a
    replicate without true positives."""
    by = list(by or [])
    cells = bootstrap_cells(preds, replicates, rate, seed, by=by, **kw)
    m = prf_cols(F.col("tp"), F.col("fp"), F.col("fn"))
    return cells.select(*by, "replicate", "n", "tp", "fp", "fn", m["f1"].alias("f1"))
