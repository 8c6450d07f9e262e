import random

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from txsentry.operators import metrics as me
from txsentry.operators.ranking import running_totals, value_counts


def preds(spark, pairs, model="A"):
    return spark.createDataFrame([(model, i, y, float(p)) for i, (y, p) in enumerate(pairs)], "model string, transaction_id long, tx_fraud int, prediction double")


def test_confusion_and_f1(spark):
    df = preds(spark, [(1, 1), (1, 0), (0, 1), (0, 0), (0, 0), (1, 1)])
    r = me.f1_score(df).first()
    assert (r["tp"], r["tn"], r["fp"], r["fn"]) == (2, 2, 1, 1)
    assert abs(r["f1"] - 2 * 2 / (2 * 2 + 1 + 1)) < 1e-12


def test_no_positives_gives_null_f1(spark):
    df = preds(spark, [(1, 0), (0, 0), (1, 0)])
    r = me.f1_score(df).first()
    assert r["tp"] == 0 and r["f1"] is None and r["precision"] is None


def test_running_totals_match_cumsum(spark):
    rnd = random.Random(11)
    vals = [rnd.randint(0, 40) for _ in range(2000)]
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    vc = value_counts(df, "x")
    for parts in (1, 4, 13):
        got = {r["v"]: (r["cum_n"], r["tot_n"]) for r in running_totals(vc, "v", ["n"], partitions=parts).collect()}
        acc = 0
        for v in sorted(set(vals)):
            acc += vals.count(v)
            assert got[float(v)] == (acc, len(vals))
        desc = {r["v"]: r["cum_n"] for r in running_totals(vc, "v", ["n"], ascending=False, partitions=parts).collect()}
        assert desc[float(max(vals))] == vals.count(max(vals))


def scored(spark, n=600, seed=5):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        y = 1 if rnd.random() < 0.3 else 0
        s = float(rnd.randint(0, 30) + 6 * y)  # ties, planted signal
        rows.append((i, y, s))
    return rows, spark.createDataFrame(rows, "transaction_id long, tx_fraud int, score double")


def test_auc_roc_matches_pair_counting(spark):
    rows, df = scored(spark)
    pos = [s for _, y, s in rows if y == 1]
    neg = [s for _, y, s in rows if y == 0]
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    got = me.auc_roc(df, partitions=7).first()
    assert abs(got["auc_roc"] - wins / (len(pos) * len(neg))) < 1e-12


def test_auc_pr_and_roc_match_mllib_without_binning(spark):
    _, df = scored(spark)
    lab = df.withColumn("tx_fraud", F.col("tx_fraud").cast("double"))
    ev_pr = BinaryClassificationEvaluator(labelCol="tx_fraud", rawPredictionCol="score", metricName="areaUnderPR", numBins=0)
    ev_roc = BinaryClassificationEvaluator(labelCol="tx_fraud", rawPredictionCol="score", metricName="areaUnderROC", numBins=0)
    assert abs(me.auc_pr(df, partitions=5).first()["area_under_pr"] - ev_pr.evaluate(lab)) < 1e-12
    assert abs(me.auc_roc(df, partitions=5).first()["auc_roc"] - ev_roc.evaluate(lab)) < 1e-12


def test_pr_curve_last_point_has_full_recall(spark):
    _, df = scored(spark)
    pts = me.pr_curve(df).orderBy("threshold").collect()
    assert pts[0]["recall"] == 1.0
    assert all(pts[i]["tp"] >= pts[i + 1]["tp"] for i in range(len(pts) - 1))


def test_rmse_and_flagged(spark):
    df = preds(spark, [(1, 1), (1, 0), (0, 1), (0, 0)])
    assert abs(me.rmse(df).first()["rmse"] - (2 / 4) ** 0.5) < 1e-12
    assert me.flagged(df).first()["n_flagged"] == 2


def test_kpi_report(spark):
    rows = [
        (1, "2024-01-03 00:00:00.000000", 100.0, 1, 0.0),  # missed fraud
        (2, "2024-01-04 00:00:00.000000", 50.0, 1, 1.0),
        (3, "2024-01-05 00:00:00.000000", 10.0, 0, 1.0),  # false decline
        (4, "2024-02-05 00:00:00.000000", 10.0, 0, 0.0),
    ]
    df = spark.createDataFrame(rows, "transaction_id long, tx_datetime string, tx_amount double, tx_fraud int, prediction double")
    got = {r["period"]: r for r in me.kpi_report(df).collect()}
    jan = got["2024-01"]
    assert jan["miss_rate"] == 0.5 and jan["missed_amount"] == 100.0 and jan["false_decline_rate"] == 1.0
    assert jan["miss_rate_ok"] is False and jan["missed_amount_ok"] is True
    assert got["2024-02"]["miss_rate"] is None
