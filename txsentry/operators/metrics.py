"""Classification metrics as single-pass aggregations.

Every function takes a prediction table with a label column (0/1) and a
prediction column (0/1) or a score column, and an optional list of grouping
columns (for example ``model``), and returns one row per group. Counts are
conditional sums in one aggregate, so the four confusion cells cost one scan
instead of four jobs, and the shuffle carries one partial row per group and task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txsentry.operators.ranking import running_totals


def _cells(label: str, pred: str) -> list[Column]:
    y = F.col(label) == 1
    p = F.col(pred) == 1
    return [
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & ~p).alias("tn"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
    ]


def confusion(df: DataFrame, label: str = "tx_fraud", pred: str = "prediction", by: list[str] | None = None) -> DataFrame:
    """tp, tn, fp, fn (as bigint) per group."""
    by = by or []
    return df.groupBy(*by).agg(*_cells(label, pred))


def prf_cols(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    """Precision, recall, F1. Undefined ratios are NULL instead of an error."""
    tp, fp, fn = tp.cast("double"), fp.cast("double"), fn.cast("double")
    precision = F.try_divide(tp, tp + fp)
    recall = F.try_divide(tp, tp + fn)
    f1 = F.when(tp > 0, F.lit(2.0) * tp / (F.lit(2.0) * tp + fp + fn))
    return {"precision": precision, "recall": recall, "f1": f1}


def f1_score(df: DataFrame, label: str = "tx_fraud", pred: str = "prediction", by: list[str] | None = None) -> DataFrame:
    """Confusion cells plus precision, recall and F1 per group. F1 is NULL when there
    is no true positive (the ratio is undefined there)."""
    by = by or []
    c = confusion(df, label, pred, by)
    m = prf_cols(F.col("tp"), F.col("fp"), F.col("fn"))
    return c.select(*by, "tp", "tn", "fp", "fn", *[v.alias(k) for k, v in m.items()])


def flagged(df: DataFrame, pred: str = "prediction", by: list[str] | None = None) -> DataFrame:
    """Number of rows predicted positive, per group."""
    by = by or []
    return df.groupBy(*by).agg(F.count_if(F.col(pred) == 1).alias("n_flagged"), F.count(F.lit(1)).alias("n_rows"))


def rmse(df: DataFrame, label: str = "tx_fraud", pred: str = "prediction", by: list[str] | None = None) -> DataFrame:
    by = by or []
    d = F.col(label).cast("double") - F.col(pred).cast("double")
    return df.groupBy(*by).agg(F.sqrt(F.avg(d * d)).alias("rmse"), F.count(d).alias("n"))


def _score_counts(df: DataFrame, label: str, score: str, by: list[str]) -> DataFrame:
    y = F.col(label).cast("long")
    return (
        df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*by, F.col(score).cast("double").alias("v"))
        .agg(F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg"))
    )


def auc_roc(df: DataFrame, label: str = "tx_fraud", score: str = "score", partitions: int | None = None) -> DataFrame:
    """Exact area under the ROC curve (ties count one half), the rank-sum form:
    sum over distinct scores of pos * (negatives below + negatives at / 2) / (P * N)."""
    vc = _score_counts(df, label, score, [])
    cum = running_totals(vc, "v", ["pos", "neg"], partitions=partitions)
    neg_below = F.col("cum_neg") - F.col("neg")
    part = F.col("pos").cast("double") * (neg_below.cast("double") + F.col("neg").cast("double") / F.lit(2.0))
    return cum.agg(
        F.try_divide(F.sum(part), F.max(F.col("tot_pos")).cast("double") * F.max(F.col("tot_neg")).cast("double")).alias("auc_roc"),
        F.max("tot_pos").cast("bigint").alias("n_pos"),
        F.max("tot_neg").cast("bigint").alias("n_neg"),
    )


def pr_curve(df: DataFrame, label: str = "tx_fraud", score: str = "score", partitions: int | None = None) -> DataFrame:
    """Precision-recall points, one per distinct score taken as the threshold
    (score >= threshold is positive), highest threshold first."""
    vc = _score_counts(df, label, score, [])
    cum = running_totals(vc, "v", ["pos", "neg"], ascending=False, partitions=partitions)
    tp = F.col("cum_pos").cast("double")
    fp = F.col("cum_neg").cast("double")
    return cum.select(
        F.col("v").alias("threshold"),
        F.col("cum_pos").cast("bigint").alias("tp"),
        F.col("cum_neg").cast("bigint").alias("fp"),
        F.try_divide(tp, F.col("tot_pos").cast("double")).alias("recall"),
        (tp / (tp + fp)).alias("precision"),
    )


def auc_pr(df: DataFrame, label: str = "tx_fraud", score: str = "score", partitions: int | None = None) -> DataFrame:
    """Area under the PR curve by the trapezoid rule over recall, with the first
    precision repeated at recall 0 (the MLlib evaluator's curve without binning).
    The previous point of each threshold comes from its own running totals minus
    its own counts, so no lag over a global order is needed."""
    vc = _score_counts(df, label, score, [])
    cum = running_totals(vc, "v", ["pos", "neg"], ascending=False, partitions=partitions)
    P = F.col("tot_pos").cast("double")
    tp, n = F.col("cum_pos").cast("double"), (F.col("cum_pos") + F.col("cum_neg")).cast("double")
    tp0, n0 = tp - F.col("pos").cast("double"), n - (F.col("pos") + F.col("neg")).cast("double")
    prec = tp / n
    prec0 = F.when(n0 > 0, tp0 / n0).otherwise(prec)
    area = (tp - tp0) / P * (prec + prec0) / F.lit(2.0)
    return cum.agg(F.sum(area).alias("area_under_pr"), F.max("tot_pos").cast("bigint").alias("n_pos"))


def kpi_report(
    df: DataFrame,
    label: str = "tx_fraud",
    pred: str = "prediction",
    amount: str = "tx_amount",
    period: Column | None = None,
    by: list[str] | None = None,
    max_miss_rate: float = 0.02,
    max_missed_amount: float = 500000.0,
    max_false_decline_rate: float = 0.05,
) -> DataFrame:
    """Business goals per period: share of fraud missed, amount missed, share of
    good transactions declined, and whether each goal is met."""
    by = list(by or [])
    period = period if period is not None else F.substring(F.col("tx_datetime"), 1, 7)
    y = F.col(label) == 1
    p = F.col(pred) == 1
    g = df.groupBy(*by, period.alias("period")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(y).alias("n_fraud"),
        F.count_if(y & ~p).alias("n_missed"),
        F.count_if(~y & p).alias("n_declined"),
        F.count_if(~y).alias("n_good"),
        # money is summed as decimal, so the order of the rows does not matter
        F.coalesce(F.sum(F.when(y & ~p, F.col(amount).cast("decimal(18,6)"))).cast("double"), F.lit(0.0)).alias("missed_amount"),
    )
    miss = F.try_divide(F.col("n_missed").cast("double"), F.col("n_fraud").cast("double"))
    fdr = F.try_divide(F.col("n_declined").cast("double"), F.col("n_good").cast("double"))
    return g.select(
        *by,
        "period",
        "n",
        "n_fraud",
        "n_missed",
        "n_declined",
        miss.alias("miss_rate"),
        fdr.alias("false_decline_rate"),
        "missed_amount",
        (miss <= F.lit(max_miss_rate)).alias("miss_rate_ok"),
        (F.col("missed_amount") <= F.lit(max_missed_amount)).alias("missed_amount_ok"),
        (fdr <= F.lit(max_false_decline_rate)).alias("false_decline_ok"),
    )


def operating_threshold(
    df: DataFrame,
    label: str = "tx_fraud",
    score: str = "score",
    amount: str = "tx_amount",
    max_miss_rate: float = 0.02,
    max_false_decline_rate: float = 0.05,
    partitions: int | None = None,
) -> DataFrame:
    """One row: the threshold (score >= threshold is declined) with the best F1 among those
    that meet both goals, the highest of them among equals; with its counts, rates and the
    amount of the fraud that it misses. Where no threshold meets the goals, or a class is
    missing, ``feasible`` is false and the rest NULL except the class sizes.

    Every distinct score is a candidate. Their counts and amounts come from distributed running
    totals, and the optimum is one global aggregate (a maximum over structs), so nothing is
    sorted in one task.
    """
    y = F.col(label).cast("long")
    money = F.coalesce(F.col(amount).cast("decimal(18,6)"), F.lit(0).cast("decimal(18,6)"))
    held = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    counts = held.groupBy(F.col(score).cast("double").alias("v")).agg(
        F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg"), F.sum(F.when(y == 1, money).otherwise(F.lit(0).cast("decimal(18,6)"))).alias("fraud")
    )
    cum = running_totals(counts, "v", ["pos", "neg", "fraud"], ascending=False, partitions=partitions)
    tp, fp, fn = F.col("cum_pos"), F.col("cum_neg"), F.col("tot_pos") - F.col("cum_pos")
    miss = F.try_divide(fn.cast("double"), F.col("tot_pos").cast("double"))
    declined = F.try_divide(fp.cast("double"), F.col("tot_neg").cast("double"))
    point = F.struct(
        prf_cols(tp, fp, fn)["f1"].alias("f1"),
        F.col("v").alias("threshold"),
        tp.cast("long").alias("tp"),
        fp.cast("long").alias("fp"),
        fn.cast("long").alias("fn"),
        miss.alias("miss_rate"),
        declined.alias("false_decline_rate"),
        (F.col("tot_fraud") - F.col("cum_fraud")).cast("double").alias("missed_amount"),
    )
    meets = (miss <= F.lit(max_miss_rate)) & (declined <= F.lit(max_false_decline_rate)) & (tp > 0)
    one = cum.agg(F.max(F.when(meets, point)).alias("b"), F.max("tot_pos").cast("long").alias("n_fraud"), F.max("tot_neg").cast("long").alias("n_good"))
    names = ["threshold", "f1", "tp", "fp", "fn", "miss_rate", "false_decline_rate", "missed_amount"]
    return one.select(F.col("b").isNotNull().alias("feasible"), *[F.col(f"b.{c}").alias(c) for c in names], F.coalesce("n_fraud", F.lit(0)).alias("n_fraud"), F.coalesce("n_good", F.lit(0)).alias("n_good"))
