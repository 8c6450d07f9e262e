"""The registered queries: one Spark callable per operator and, where the result
is SQL-expressible, the same result written as DuckDB SQL over the driver's
tables.

Inputs: ``events`` mapped to the raw transaction table (see
``txsentry.sources.tables``). Every query reads the whole table. Metric queries
use two fixed rule models (A: amount > 60, B: amount > 30) so that their
results can be reproduced by SQL.

The model-fitting queries learn a planted label, a rule on a feature with eight values
(``_planted``), so a right model's predictions, its top feature, its logged metrics and
its saved copy's agreement can be stated in SQL, and so can which search trials reach a
metric and which one wins. What the oracles do not cover: the models' probabilities.

Double columns are rounded to 6 places on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txsentry.functions.timefeat import TS_FORMAT
from txsentry.operators import abtest, clean as cl, features as fe, metrics as me, ml, sampling, sketches, stats
from txsentry.plans import jobs
from txsentry.session import ensure_conf, scratch_path
from txsentry.sources import files
from txsentry.sources.tables import FEATURES, ID, LABEL, TX_SCHEMA, TX_SQL, tx
from txsentry.streaming import messages as msg
from txsentry.streaming import score as st

ROUND = 6

# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------


def finish(df: DataFrame) -> DataFrame:
    """Round double columns to ROUND places (the oracle does the same)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name), ROUND).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _tx(spark: SparkSession, sf: str) -> DataFrame:
    ensure_conf(spark)
    return tx(spark, sf)


def _base(spark, sf):
    return cl.drop_null_key(cl.filter_sentinel(cl.dedup_rows(_tx(spark, sf))))


def _clean(spark, sf, keep=None):
    """The clean table; only the columns ``keep`` (and the amount) are staged."""
    return cl.clean(_tx(spark, sf), stage_path=scratch_path(spark, "dedup"), keep=keep)


def _filled(spark, sf, keep=None):
    """The clean table as the jobs prepare it; keys come from whole rows, whatever is kept."""
    rows = cl.clean(jobs.with_key(_tx(spark, sf)), stage_path=scratch_path(spark, "dedup"), keep=keep)
    return jobs.prepared(rows)


def _split(spark, sf, keep=None):
    return jobs.train_test(_filled(spark, sf, keep))


RULE_COLUMNS = [ID, LABEL, "tx_amount"]


def _planted(df):
    """The terminal as one of eight groups, and a label that is a rule on it."""
    group = F.pmod(F.col("terminal_id"), F.lit(8))
    return df.withColumn("terminal_id", group).withColumn(LABEL, (group >= 4).cast("int"))


def _ml_split(spark, sf):
    """Train / test parts for model fitting. A fit makes many passes over its input
    (scaler statistics, split candidates, one pass per tree level), so the prepared
    rows are written once to the shared scratch folder and read back: each pass
    then scans a file instead of re-running the dedup and the fence, and a lost
    executor does not send the fit back to the raw table."""
    rows = _planted(_filled(spark, sf, [ID, LABEL, *FEATURES]))
    return jobs.train_test(files.materialize(rows, scratch_path(spark, "ml-input")))


def _rules():
    return ml.rule_model(jobs.RULE_A_THRESHOLD), ml.rule_model(jobs.RULE_B_THRESHOLD)


def _pred_test(spark, sf):
    _, test = _split(spark, sf, RULE_COLUMNS)
    a, b = _rules()
    return jobs.predictions_ab(test, a, b)


def _scored_all(spark, sf):
    """Both rule models on every clean row, long form with amount and time. One scan:
    B scores A's output, then the pair is unpivoted."""
    df = _filled(spark, sf, [*RULE_COLUMNS, "tx_datetime"])
    a, b = _rules()
    base = [ID, LABEL, "tx_amount", "tx_datetime"]
    sa = a.transform(df).select(*base, F.col("prediction").alias("prediction_a"), F.col("score").alias("score_a"))
    sb = b.transform(sa).select(*base, "prediction_a", "score_a", F.col("prediction").alias("prediction_b"), F.col("score").alias("score_b"))
    pairs = F.array(
        *[F.struct(F.lit(m).alias("model"), F.col(f"prediction_{m.lower()}").alias("prediction"), F.col(f"score_{m.lower()}").alias("score")) for m in ("A", "B")]
    )
    return sb.select(*base, F.inline(pairs)).select("model", *base, "prediction", "score")


def _samples(spark, sf):
    return sampling.bootstrap_f1(_pred_test(spark, sf), jobs.BOOT_REPLICATES, jobs.BOOT_RATE, by=["model"])


def q_scan_parquet(spark, sf):
    return _tx(spark, sf)


def q_scan_csv(spark, sf):
    path = scratch_path(spark, "tx-csv")
    files.write_csv(_tx(spark, sf), path)
    return files.read_csv(spark, path, TX_SCHEMA)


def q_write_parquet(spark, sf):
    path = scratch_path(spark, "clean-parquet")
    files.write_parquet(_clean(spark, sf), path)
    return files.read_parquet(spark, path)


def q_dedup_rows(spark, sf):
    return cl.dedup_rows(_tx(spark, sf))


def q_filter_sentinel(spark, sf):
    return cl.filter_sentinel(_tx(spark, sf))


def q_drop_null_key(spark, sf):
    return cl.drop_null_key(_tx(spark, sf))


def q_fill_zero(spark, sf):
    return cl.fill_zero(_tx(spark, sf))


def q_quantiles(spark, sf):
    q = cl.quantiles(_base(spark, sf), "tx_amount", [0.25, 0.5, 0.75])
    return q.select(F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75"))


def q_iqr_fences(spark, sf):
    return cl.iqr_fences(_base(spark, sf))


# The reference's own fence: approximate quartiles with relative rank error 0.05.
# Greenwald-Khanna summaries merge map-side; the result is within the rank error of
# the exact one, not equal to it, so these two have no value oracle.
APPROX_REL_ERROR = 0.05


def q_quantiles_approx(spark, sf):
    q = cl.quantiles(_base(spark, sf), "tx_amount", [0.25, 0.5, 0.75], method="approx", rel_error=APPROX_REL_ERROR)
    return q.select(F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75"))


def q_quantiles_approx_within(spark, sf):
    """Whether the rank of each approximate quartile lies within the error."""
    base = _base(spark, sf).select("tx_amount").filter("tx_amount is not null")
    q = cl.quantiles(base, "tx_amount", [0.25, 0.5, 0.75], method="approx", rel_error=APPROX_REL_ERROR)
    n, below, upto = F.count(F.lit(1)), {}, {}
    for i in range(3):
        v = q.select(f"q{i}").scalar()
        below[i], upto[i] = F.count_if(F.col("tx_amount") < v) / n, F.count_if(F.col("tx_amount") <= v) / n
    within = [((below[i] <= p + APPROX_REL_ERROR) & (upto[i] >= p - APPROX_REL_ERROR)).alias(c) for i, (p, c) in enumerate([(0.25, "p25"), (0.5, "p50"), (0.75, "p75")])]
    return base.agg(*within)


SKETCH_RUNS = 3


def q_quantiles_sketched(spark, sf):
    """Quartiles merged from stored sketches of each day and run, without a look at old
    rows: their number of values and days, and whether each one's rank is within the
    sketch's error (twice, as the rank on either side counts)."""
    base = files.materialize(_base(spark, sf).select(ID, "tx_time_days", "tx_amount"), scratch_path(spark, "sketch-input"))
    path = scratch_path(spark, "day-sketches")
    for r in range(SKETCH_RUNS):
        sketches.store(sketches.day_sketches(base.filter(F.pmod(ID, F.lit(SKETCH_RUNS)) == r), "tx_amount"), path, f"run{r}")
    stored = sketches.stored(spark, path)
    q = files.materialize(sketches.quantiles_from(stored, [0.25, 0.5, 0.75]), scratch_path(spark, "sketch-quartiles"))
    v, n = F.col("tx_amount"), F.count("tx_amount")
    within = []
    for i, (p, c) in enumerate([(0.25, "p25"), (0.5, "p50"), (0.75, "p75")]):
        x = q.select(f"q{i}").scalar()
        slack = 2 * sketches.RANK_ERROR
        within.append(((F.count_if(v < x) / n <= p + slack) & (F.count_if(v <= x) / n >= p - slack)).alias(c))
    days = stored.agg(F.count_distinct("day").alias("n")).select("n").scalar()
    return base.agg(*within).select("p25", "p50", "p75", q.select("n").scalar().alias("n_values"), days.alias("n_days"))


def q_clean_iqr_approx(spark, sf):
    return cl.clean(_tx(spark, sf), method="approx", rel_error=APPROX_REL_ERROR, stage_path=scratch_path(spark, "dedup"))


def q_clean_iqr(spark, sf):
    return _clean(spark, sf)


def q_project_features(spark, sf):
    return fe.project_features(_clean(spark, sf, [*FEATURES, LABEL]))


def q_tx_time_feature(spark, sf):
    return fe.with_tx_time(_tx(spark, sf), out="tx_time").select(ID, "tx_time")


def q_time_parts(spark, sf):
    return fe.with_time_parts(_tx(spark, sf).select(ID, "tx_datetime"), fmt=TS_FORMAT).drop("tx_datetime")


def q_describe(spark, sf):
    return stats.describe(_clean(spark, sf, [*FEATURES, LABEL]), [*FEATURES, LABEL])


def q_schema_profile(spark, sf):
    return stats.schema_profile(_tx(spark, sf), exact=TX_SCHEMA.names)


def q_flagged(spark, sf):
    return me.flagged(_pred_test(spark, sf), by=["model"])


def q_confusion(spark, sf):
    return me.confusion(_pred_test(spark, sf), by=["model"])


def q_f1_score(spark, sf):
    return me.f1_score(_pred_test(spark, sf), by=["model"])


def q_rmse(spark, sf):
    return me.rmse(_pred_test(spark, sf), by=["model"])


def q_auc_roc(spark, sf):
    return me.auc_roc(_filled(spark, sf, RULE_COLUMNS), score="tx_amount")


def q_pr_curve(spark, sf):
    return me.pr_curve(_filled(spark, sf, RULE_COLUMNS), score="tx_amount")


def q_auc_pr(spark, sf):
    return me.auc_pr(_filled(spark, sf, RULE_COLUMNS), score="tx_amount")


def q_operating_threshold(spark, sf):
    """The best threshold within the goals on a label that the score nearly tells (one row in
    97 is mislabelled), and on the raw label, which no score here can tell."""
    rows = _filled(spark, sf, [ID, LABEL, "tx_amount", "terminal_id"])
    rows = files.materialize(rows, scratch_path(spark, "threshold-input"))
    group = F.pmod(F.col("terminal_id"), F.lit(8))
    odd = F.pmod(F.col(ID), F.lit(97)) == 0
    planted = rows.select(((group >= 4) != odd).cast("int").alias(LABEL), (group + F.col("tx_amount") / F.lit(1000.0)).alias("score"), "tx_amount")
    raw = rows.select(LABEL, F.col("tx_amount").alias("score"), "tx_amount")
    one = me.operating_threshold(planted).withColumn("label", F.lit("planted"))
    return one.unionByName(me.operating_threshold(raw).withColumn("label", F.lit("raw")))


def q_kpi_report(spark, sf):
    return me.kpi_report(_scored_all(spark, sf), by=["model"])


def q_split_hash(spark, sf):
    lab = sampling.split_label(ID, jobs.SPLIT_WEIGHTS, ["train", "test"], jobs.SPLIT_SEED)
    return _filled(spark, sf, [ID]).select(ID, lab.alias("part"))


def _split_variant(weights, seed):
    def run(spark, sf):
        lab = sampling.split_label(ID, weights, ["train", "test"], seed)
        return _filled(spark, sf, [ID]).select(ID, lab.alias("part"))

    return run


def q_split_groups(spark, sf):
    """The test part of the 90 / 10 split in two groups of equal weight."""
    _, test = _split(spark, sf, [ID])
    return test.select(ID, sampling.split_label(ID, [0.5, 0.5], ["A", "B"], GROUP_SEED).alias("part"))


# Seeds of the other splits. The group split hashes with a seed of its own: with the
# outer split's seed all its rows would fall into one group.
BASELINE_SEED, GROUP_SEED = 24, 4242


def q_bootstrap_f1(spark, sf):
    return _samples(spark, sf)


def q_bootstrap_f1_cells(spark, sf):
    return sampling.bootstrap_f1(_pred_test(spark, sf), jobs.BOOT_REPLICATES, jobs.BOOT_RATE, by=["model"], mode="cells")


def q_f1_interval(spark, sf):
    return abtest.f1_interval(_samples(spark, sf))


def q_mann_whitney(spark, sf):
    return abtest.mann_whitney(_samples(spark, sf))


EXACT_REPLICATES = 8


def q_mann_whitney_exact(spark, sf):
    """The exact test on the first eight replicates of each model."""
    few = _samples(spark, sf).filter(F.col("replicate") < EXACT_REPLICATES)
    return abtest.mann_whitney(few, p_method="exact")


def q_mcnemar(spark, sf):
    """Two rules that differ on few rows."""
    _, test = _split(spark, sf, RULE_COLUMNS)
    a, _ = _rules()
    return abtest.mcnemar(jobs.side_by_side(test, a, ml.rule_model(jobs.RULE_A_THRESHOLD + 2.0)))


def q_ab_verdict(spark, sf):
    return abtest.ab_verdict(_samples(spark, sf))


def q_ab_verdict_undefined(spark, sf):
    """Model B flags nothing, so its F1 is undefined in every replicate."""
    _, test = _split(spark, sf, RULE_COLUMNS)
    a, _ = _rules()
    preds = jobs.predictions_ab(test, a, ml.rule_model(1e300))
    return abtest.ab_verdict(sampling.bootstrap_f1(preds, jobs.BOOT_REPLICATES, jobs.BOOT_RATE, by=["model"]))


def q_histogram(spark, sf):
    return stats.histogram(_samples(spark, sf), "f1", bins=3, by=["model"])


def q_ab_paired(spark, sf):
    _, test = _split(spark, sf, RULE_COLUMNS)
    a, b = _rules()
    return abtest.ab_paired(jobs.side_by_side(test, a, b))


def q_score_batch(spark, sf):
    return _pred_test(spark, sf)


def q_assemble(spark, sf):
    out = fe.assembler().transform(_clean(spark, sf, [ID, *FEATURES])).select(ID, "features")
    return fe.vector_columns(out, "features", FEATURES, "f_")


def q_minmax_scale(spark, sf):
    rows = files.materialize(_filled(spark, sf, [ID, *FEATURES]), scratch_path(spark, "ml-input"))
    train, _ = jobs.train_test(rows)
    model = Pipeline(stages=[fe.assembler(), fe.scaler()]).fit(train)
    out = model.transform(rows).select(ID, "scaledFeatures")
    return fe.vector_columns(out, "scaledFeatures", FEATURES, "s_")


def _messages(spark, sf):
    """Messages as the producer frames them; every 50th one also comes broken, and
    another one with its rows twice (repeated ids in one message)."""
    good = files.materialize(msg.messages_from_tx(_tx(spark, sf)), scratch_path(spark, "messages"))
    first = good.filter("partition = 0")
    broken = first.filter(F.col("offset") % 50 == 7).select("topic", F.lit(1000).alias("partition"), "offset", F.concat(F.lit("broken "), "value").alias("value"))
    rows = F.col("value").substr(F.lit(2), F.length("value") - 2)
    twice = first.filter(F.col("offset") % 50 == 9).select("topic", F.lit(1001).alias("partition"), "offset", F.concat(F.lit("["), rows, F.lit(","), rows, F.lit("]")).alias("value"))
    return good.unionByName(broken).unionByName(twice)


def q_decode_messages(spark, sf):
    return msg.decode_messages(_messages(spark, sf))


def q_encode_predictions(spark, sf):
    a, _ = _rules()
    rows = msg.decode_messages(_messages(spark, sf)).filter("is_valid")
    return msg.encode_predictions(a.transform(fe.with_tx_time(rows)))


def _run_score_stream(spark, sf):
    src, sink, bad = (scratch_path(spark, n) for n in ("messages", "predicted", "bad-rows"))
    files.write_parquet(_messages(spark, sf), src)
    a, _ = _rules()
    q = st.score_stream(st.file_message_source(spark, src), a, st.parquet_batch_sink(sink), st.bad_rows_parquet_sink(bad), scratch_path(spark, "ckpt-score"), available_now=True)
    q.awaitTermination()
    return spark.read.parquet(sink).drop("epoch"), spark.read.parquet(bad).drop("epoch")


def q_stream_score(spark, sf):
    return _run_score_stream(spark, sf)[0]


def q_stream_bad_rows(spark, sf):
    """The side output of the scoring stream."""
    return _run_score_stream(spark, sf)[1]


BUCKET_ROWS = 250_000  # a bucket's digests are in one task's memory during a micro-batch


def q_stream_clean(spark, sf):
    """The raw table arrives in four micro-batches in no order of time."""
    src, sink = scratch_path(spark, "tx-stream"), scratch_path(spark, "clean-stream")
    files.write_parquet(_tx(spark, sf).repartition(4), src)
    fence = cl.iqr_fences(_base(spark, sf).select("tx_amount")).first()["upper_fence"]
    buckets = max(st.BUCKETS, -(-files.read_parquet(spark, src).count() // BUCKET_ROWS))
    q = st.clean_stream_to(st.tx_file_source(spark, src, max_files=1), sink, fence, scratch_path(spark, "ckpt-clean"), available_now=True, buckets=buckets)
    q.awaitTermination()
    return spark.read.parquet(sink).select(TX_SCHEMA.names)


KPI_PARTS, KPI_SPAN_DAYS, KPI_DELAY_DAYS = 4, 24, 30


def q_kpi_stream(spark, sf):
    """Daily goals of both rule models from a stream: the rows arrive in several micro-batches, by
    spans of days with no order inside a span, and windows come out once they are closed."""
    src, sink = scratch_path(spark, "scored-stream"), scratch_path(spark, "kpi-stream")
    rows = _scored_all(spark, sf).select("model", "tx_datetime", LABEL, "prediction", "tx_amount")
    rows = files.materialize(rows, scratch_path(spark, "kpi-input"))
    span = F.floor(F.datediff(F.col("tx_datetime").try_cast("timestamp"), F.lit("2024-01-01").cast("date")) / F.lit(KPI_SPAN_DAYS))
    for i in range(KPI_PARTS):
        rows.filter(span == i).write.mode("append").parquet(src)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(src)
    out = st.kpi_stream(stream, "1 day", f"{KPI_DELAY_DAYS} days", by=["model"])
    w = out.writeStream.format("parquet").outputMode("append").option("path", sink).option("checkpointLocation", scratch_path(spark, "ckpt-kpi"))
    w.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(out.schema).parquet(sink).withColumn("period", F.date_format("window_start", "yyyy-MM-dd")).drop("window_start", "window_end")


def q_ml_metrics(spark, sf):
    a, _ = _rules()
    scored = a.transform(_filled(spark, sf, RULE_COLUMNS))
    m = ml.ml_metrics(scored, raw="score", num_bins=0)
    return spark.createDataFrame([(m["f1_label1"], m["area_under_pr"], m["area_under_roc"], m["rmse"])], "f1_label1 double, area_under_pr double, area_under_roc double, rmse double")


# --- model training on the planted label ----------------------------------------


def _predictions(model, test):
    return ml.score(model, test).select(ID, LABEL, "prediction")


def q_train_rf(spark, sf):
    train, test = _ml_split(spark, sf)
    return _predictions(ml.fit_forest(ml.rf_pipeline(), train), test)


def q_train_rf_baseline(spark, sf):
    train, test = _ml_split(spark, sf)
    return _predictions(ml.fit_forest(ml.rf_baseline(), train), test)


def q_train_gbt(spark, sf):
    train, test = _ml_split(spark, sf)
    return _predictions(ml.gbt_pipeline().fit(train), test)


def q_train_dt_ab(spark, sf):
    train, test = _ml_split(spark, sf)
    ma = ml.dt_pipeline(**ml.DT_A_PARAMS).fit(train)
    mb = ml.dt_pipeline(**ml.DT_B_PARAMS).fit(train)
    return jobs.predictions_ab(test, ma, mb)


def q_importances(spark, sf):
    """Per feature whether it is the most important one, and the importances' sum."""
    train, _ = _ml_split(spark, sf)
    found = ml.importances_frame(spark, ml.fit_forest(ml.rf_pipeline(), train), name="rf")
    every = Window.partitionBy("model")
    return found.select("model", "feature", (F.col("importance") == F.max("importance").over(every)).alias("is_top"), F.sum("importance").over(every).alias("total"))


TRIALS_AT_ONCE = 8
TRIAL_COLUMNS = ["method", "trial", "params", "num_trees", "max_depth", "impurity", "metric"]
# What the fits decide: whether a trial's metric reaches this, and which trial wins.
REACHED = 0.99


def _trials(found):
    return found.select(*TRIAL_COLUMNS, (F.col("value") >= REACHED).alias("reached"), "is_best")


def _deep(df):
    """A label that no tree of depth 2 can learn: the parity of the group's three bits."""
    group = F.col("terminal_id")
    odd = group.bitwiseXOR(F.shiftright(group, 1)).bitwiseXOR(F.shiftright(group, 2)).bitwiseAND(F.lit(1))
    return df.withColumn(LABEL, odd.cast("int"))


def q_tune_grid(spark, sf):
    """Trials on a label that takes deep trees, so the winner is the first deep one."""
    train, _ = _ml_split(spark, sf)
    return _trials(ml.tune_grid(_deep(train))[1])


def q_tune_random(spark, sf):
    train, _ = _ml_split(spark, sf)
    return _trials(ml.tune_random(train, parallelism=TRIALS_AT_ONCE)[1])


def q_tune_cv(spark, sf):
    train, _ = _ml_split(spark, sf)
    return _trials(ml.tune_cv(train, parallelism=TRIALS_AT_ONCE)[1])


def q_best_params(spark, sf):
    """The winner's searched parameters; the grid has one forest size and depth."""
    train, _ = _ml_split(spark, sf)
    model, _ = ml.tune_grid(train, num_trees=(40,), max_depth=(7,))
    return ml.best_params(spark, model).filter(F.col("param").isin("numTrees", "maxDepth", "impurity", "seed"))


def q_best_params_grid(spark, sf):
    """The searched parameters of the model that wins the default grid on the deep label."""
    train, _ = _ml_split(spark, sf)
    model, _ = ml.tune_grid(_deep(train))
    return ml.best_params(spark, model).filter(F.col("param").isin("numTrees", "maxDepth", "impurity", "seed"))


def q_model_roundtrip(spark, sf):
    """The test rows scored by a saved and loaded model, and whether the model scored
    them alike before."""
    train, test = _ml_split(spark, sf)
    model = ml.dt_pipeline(**ml.DT_B_PARAMS).fit(train)
    path = ml.save_model(model, scratch_path(spark, "model-dt"))
    both = jobs.side_by_side(test, model, ml.load_model(path))
    return both.select(ID, LABEL, F.col("prediction_b").alias("prediction"), (F.col("prediction_a") == F.col("prediction_b")).alias("same"))


def q_run_log(spark, sf):
    train, test = _ml_split(spark, sf)
    model = ml.dt_pipeline(**ml.DT_B_PARAMS).fit(train)
    scored = ml.score(model, test)
    auc = me.auc_pr(scored, score="p_fraud").first()["area_under_pr"]
    f1 = me.f1_score(scored).first()["f1"]
    return ml.log_run(spark, scratch_path(spark, "runs"), "dt_md7", {"features": FEATURES, **ml.DT_B_PARAMS}, {"areaUnderPR": auc, "f1": f1}).drop("logged_at")


SPARK_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_iqr": q_clean_iqr,
    "scan_parquet": q_scan_parquet,
    "scan_csv": q_scan_csv,
    "write_parquet": q_write_parquet,
    "dedup_rows": q_dedup_rows,
    "filter_sentinel": q_filter_sentinel,
    "drop_null_key": q_drop_null_key,
    "fill_zero": q_fill_zero,
    "quantiles": q_quantiles,
    "iqr_fences": q_iqr_fences,
    "quantiles_approx": q_quantiles_approx,
    "quantiles_approx_within": q_quantiles_approx_within,
    "quantiles_sketched": q_quantiles_sketched,
    "clean_iqr_approx": q_clean_iqr_approx,
    "project_features": q_project_features,
    "tx_time_feature": q_tx_time_feature,
    "time_parts": q_time_parts,
    "describe": q_describe,
    "schema_profile": q_schema_profile,
    "flagged": q_flagged,
    "confusion": q_confusion,
    "f1_score": q_f1_score,
    "rmse": q_rmse,
    "auc_roc": q_auc_roc,
    "pr_curve": q_pr_curve,
    "auc_pr": q_auc_pr,
    "kpi_report": q_kpi_report,
    "operating_threshold": q_operating_threshold,
    "split_hash": q_split_hash,
    "split_90_10_seed24": _split_variant([0.9, 0.1], BASELINE_SEED),
    "split_95_5_seed42": _split_variant(jobs.TRAIN_WEIGHTS, jobs.SPLIT_SEED),
    "split_groups": q_split_groups,
    "bootstrap_f1": q_bootstrap_f1,
    "bootstrap_f1_cells": q_bootstrap_f1_cells,
    "f1_interval": q_f1_interval,
    "mann_whitney": q_mann_whitney,
    "mann_whitney_exact": q_mann_whitney_exact,
    "mcnemar": q_mcnemar,
    "ab_verdict": q_ab_verdict,
    "ab_verdict_undefined": q_ab_verdict_undefined,
    "histogram": q_histogram,
    "ab_paired": q_ab_paired,
    "score_batch": q_score_batch,
    "assemble": q_assemble,
    "minmax_scale": q_minmax_scale,
    "decode_messages": q_decode_messages,
    "encode_predictions": q_encode_predictions,
    "stream_score": q_stream_score,
    "stream_bad_rows": q_stream_bad_rows,
    "stream_clean": q_stream_clean,
    "kpi_stream": q_kpi_stream,
    "ml_metrics": q_ml_metrics,
    "train_rf": q_train_rf,
    "train_rf_baseline": q_train_rf_baseline,
    "train_gbt": q_train_gbt,
    "train_dt_ab": q_train_dt_ab,
    "importances": q_importances,
    "tune_grid": q_tune_grid,
    "tune_random": q_tune_random,
    "tune_cv": q_tune_cv,
    "best_params": q_best_params,
    "best_params_grid": q_best_params_grid,
    "model_roundtrip": q_model_roundtrip,
    "run_log": q_run_log,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finish(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run

    return {k: wrap(v) for k, v in SPARK_QUERIES.items()}


# ---------------------------------------------------------------------------
# DuckDB side
# ---------------------------------------------------------------------------

# The constants below are written out by hand, apart from the Python lists.


def _u(seed: int) -> str:
    """A uniform number from the row's id: the first 32 bits of md5('seed:id')."""
    return f"(CAST(('0x' || substr(md5('{seed}:' || CAST(transaction_id AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296e0)"


_U_SPLIT = _u(42)
# Replicate r of a model reads 32-bit lane r mod 4 of md5('42:model:(r div 4):id').
_U_BOOT = (
    "(CAST(('0x' || substr(md5('42:' || model || ':' || CAST(replicate // 4 AS VARCHAR) || ':' || CAST(transaction_id AS VARCHAR)), "
    "8 * (replicate % 4) + 1, 8)) AS BIGINT) / 4294967296e0)"
)
# Poisson(0.8): the weight is how many of P(X <= 0), P(X <= 1), ... the uniform reaches.
_W_BOOT = (
    "(CASE WHEN u < 0.449328964117 THEN 0 WHEN u < 0.808792135411 THEN 1 WHEN u < 0.952577403929 THEN 2 WHEN u < 0.990920142200 THEN 3 "
    "WHEN u < 0.998588689854 THEN 4 WHEN u < 0.999815657479 THEN 5 WHEN u < 0.999979253162 THEN 6 WHEN u < 0.999997949812 THEN 7 "
    "WHEN u < 0.999999819477 THEN 8 WHEN u < 0.999999985669 THEN 9 WHEN u < 0.999999998964 THEN 10 ELSE 11 END)"
)
# Two-sided normal tail of z: erfc(x) at x = z / sqrt(2) (x >= 0) by the ten-term
# Chebyshev fit in t = 1 / (1 + x / 2), written as a plain polynomial.
_ERFC = (
    "(t * exp(-x * x - 1.26551223e0 + 1.00002368e0 * t + 0.37409196e0 * t ** 2 + 0.09678418e0 * t ** 3 - 0.18628806e0 * t ** 4 "
    "+ 0.27886807e0 * t ** 5 - 1.13520398e0 * t ** 6 + 1.48851587e0 * t ** 7 - 0.82215223e0 * t ** 8 + 0.17087277e0 * t ** 9))"
)

# Named building blocks, in dependency order.
CTES: list[tuple[str, str]] = [
    ("tx", TX_SQL.strip()[1:-1]),
    ("dedup", "SELECT DISTINCT * FROM tx"),
    ("base", "SELECT * FROM dedup WHERE customer_id <> -999999 AND terminal_id IS NOT NULL"),
    (
        "fence",
        "SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5e0 * (q3 - q1) AS lower_fence, q3 + 1.5e0 * (q3 - q1) AS upper_fence "
        "FROM (SELECT CAST(quantile_disc(tx_amount, 0.25) AS DOUBLE) AS q1, CAST(quantile_disc(tx_amount, 0.75) AS DOUBLE) AS q3 "
        "FROM base WHERE tx_amount IS NOT NULL)",
    ),
    ("clean", "SELECT * FROM base WHERE tx_amount <= (SELECT upper_fence FROM fence)"),
    (
        "filled",
        "SELECT coalesce(transaction_id, 0) AS transaction_id, tx_datetime, coalesce(customer_id, 0) AS customer_id, "
        "coalesce(terminal_id, 0) AS terminal_id, coalesce(tx_amount, 0) AS tx_amount, coalesce(tx_time_seconds, 0) AS tx_time_seconds, "
        "coalesce(tx_time_days, 0) AS tx_time_days, coalesce(tx_fraud, 0) AS tx_fraud, coalesce(tx_fraud_scenario, 0) AS tx_fraud_scenario FROM clean",
    ),
    ("labeled", f"SELECT *, CASE WHEN {_U_SPLIT} < 0.9e0 THEN 'train' ELSE 'test' END AS part FROM filled"),
    ("train", "SELECT * EXCLUDE (part) FROM labeled WHERE part = 'train'"),
    ("test", "SELECT * EXCLUDE (part) FROM labeled WHERE part = 'test'"),
    (
        "pred",
        "SELECT 'A' AS model, transaction_id, tx_fraud, CAST(tx_amount > 60.0e0 AS DOUBLE) AS prediction FROM test "
        "UNION ALL SELECT 'B' AS model, transaction_id, tx_fraud, CAST(tx_amount > 30.0e0 AS DOUBLE) AS prediction FROM test",
    ),
    (
        "scored_all",
        "SELECT 'A' AS model, *, CAST(tx_amount > 60.0e0 AS DOUBLE) AS prediction FROM filled "
        "UNION ALL SELECT 'B' AS model, *, CAST(tx_amount > 30.0e0 AS DOUBLE) AS prediction FROM filled",
    ),
    (
        "boot_rows",
        "SELECT model, transaction_id, CAST(tx_fraud AS BIGINT) AS y, CAST(prediction AS BIGINT) AS p, "
        "unnest(range(0, 50)) AS replicate FROM pred",
    ),
    (
        "boot",
        f"SELECT model, CAST(replicate AS INTEGER) AS replicate, "
        f"CAST(sum(w * y * p) AS BIGINT) AS tp, CAST(sum(w * (1 - y) * p) AS BIGINT) AS fp, "
        f"CAST(sum(w * y * (1 - p)) AS BIGINT) AS fn, CAST(sum(w) AS BIGINT) AS n "
        f"FROM (SELECT *, {_W_BOOT} AS w FROM (SELECT *, {_U_BOOT} AS u FROM boot_rows)) GROUP BY model, replicate",
    ),
    (
        "samples",
        "SELECT model, replicate, n, tp, fp, fn, "
        "CASE WHEN tp > 0 THEN 2e0 * tp / (2e0 * tp + fp + fn) END AS f1 FROM boot",
    ),
    (
        "intervals",
        "SELECT model, avg(f1) AS mean, stddev_pop(f1) AS std, avg(f1) - 3e0 * stddev_pop(f1) AS lo, "
        "avg(f1) + 3e0 * stddev_pop(f1) AS hi, count(f1) AS n_defined, CAST(count_if(f1 IS NULL) AS BIGINT) AS n_undefined "
        "FROM samples GROUP BY model",
    ),
    (
        "mw_v",
        "SELECT v, count(*) AS n, sum(CASE WHEN model = 'A' THEN 1 ELSE 0 END) AS n_a "
        "FROM (SELECT model, CAST(f1 AS DOUBLE) AS v FROM samples WHERE f1 IS NOT NULL AND model IN ('A', 'B')) GROUP BY v",
    ),
    ("mw_c", "SELECT *, sum(n) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_n FROM mw_v"),
    (
        "mw_s",
        "SELECT sum(n_a * ((cum_n - n) + (n + 1e0) / 2e0)) AS r1, CAST(sum(n_a) AS DOUBLE) AS n1, "
        "CAST(sum(n - n_a) AS DOUBLE) AS n2, sum(CAST(n AS DOUBLE) * n * n - n) AS ties FROM mw_c",
    ),
    (
        "mw_u",
        "SELECT n1, n2, ties, r1 - n1 * (n1 + 1e0) / 2e0 AS u1, n1 * n2 - (r1 - n1 * (n1 + 1e0) / 2e0) AS u2 FROM mw_s",
    ),
    (
        "mw_z",
        "SELECT n1, n2, u1, u2, (greatest(u1, u2) - n1 * n2 / 2e0 - 0.5e0) / "
        "(CASE WHEN sqrt(n1 * n2 / 12e0 * ((n1 + n2 + 1e0) - ties / ((n1 + n2) * (n1 + n2 - 1e0)))) > 0 "
        "THEN sqrt(n1 * n2 / 12e0 * ((n1 + n2 + 1e0) - ties / ((n1 + n2) * (n1 + n2 - 1e0)))) END) AS z FROM mw_u",
    ),
    (
        "mw",
        "SELECT CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, u1, u2, z, CASE WHEN z IS NULL THEN NULL "
        f"WHEN z >= 0 THEN least(1e0, {_ERFC}) ELSE least(1e0, 2e0 - {_ERFC}) END AS p_value "
        "FROM (SELECT *, 1e0 / (1e0 + 0.5e0 * x) AS t FROM (SELECT *, abs(z) / sqrt(2e0) AS x FROM mw_z))",
    ),
    (
        "good_rows",
        "SELECT 'data' AS topic, \"partition\", CAST(floor(transaction_id / 5) AS BIGINT) AS \"offset\", "
        "CAST(row_number() OVER (PARTITION BY \"partition\", floor(transaction_id / 5) ORDER BY transaction_id) - 1 AS INTEGER) AS pos, "
        "transaction_id, tx_datetime, customer_id, terminal_id, tx_amount, "
        "customer_id IS NOT NULL AND terminal_id IS NOT NULL AND tx_amount IS NOT NULL AS is_valid "
        "FROM (SELECT *, CAST(row_number() OVER (PARTITION BY transaction_id) - 1 AS INTEGER) AS \"partition\" FROM tx)",
    ),
    (
        "messages_rows",
        "SELECT * FROM good_rows UNION ALL SELECT DISTINCT topic, CAST(1000 AS INTEGER), \"offset\", CAST(NULL AS INTEGER), CAST(NULL AS BIGINT), "
        "CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT), CAST(NULL AS INTEGER), CAST(NULL AS DOUBLE), false "
        "FROM good_rows WHERE \"partition\" = 0 AND \"offset\" % 50 = 7 "
        "UNION ALL SELECT topic, CAST(1001 AS INTEGER), \"offset\", CAST(pos + again * (count(*) OVER (PARTITION BY \"offset\", again)) AS INTEGER), "
        "transaction_id, tx_datetime, customer_id, terminal_id, tx_amount, is_valid "
        "FROM good_rows, (VALUES (0), (1)) AS t(again) WHERE \"partition\" = 0 AND \"offset\" % 50 = 9",
    ),
    (
        "answers",
        "SELECT topic, \"partition\", \"offset\", transaction_id, max(pos) AS pos, max(CAST(tx_amount > 60.0e0 AS INTEGER)) AS flag, count(*) AS n "
        "FROM messages_rows WHERE is_valid GROUP BY ALL",
    ),
    (
        "encoded",
        "SELECT topic, \"partition\", \"offset\", '{' || string_agg('\"' || CAST(transaction_id AS VARCHAR) || '\":' || "
        "CASE WHEN flag = 1 THEN '1.0' ELSE '0.0' END, ',' ORDER BY pos) || '}' AS value, "
        "CAST(sum(n) AS INTEGER) AS n_rows FROM answers GROUP BY topic, \"partition\", \"offset\"",
    ),
    (
        "score_counts",
        "SELECT CAST(tx_amount AS DOUBLE) AS v, sum(CAST(tx_fraud AS BIGINT)) AS pos, sum(1 - CAST(tx_fraud AS BIGINT)) AS neg "
        "FROM filled WHERE tx_amount IS NOT NULL AND tx_fraud IS NOT NULL GROUP BY 1",
    ),
    (
        "asc_cum",
        "SELECT *, sum(neg) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg, "
        "sum(pos) OVER () AS tot_pos, sum(neg) OVER () AS tot_neg FROM score_counts",
    ),
    (
        "desc_cum",
        "SELECT *, sum(pos) OVER (ORDER BY v DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos, "
        "sum(neg) OVER (ORDER BY v DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg, "
        "sum(pos) OVER () AS tot_pos FROM score_counts",
    ),
    (
        "roc",
        "SELECT sum(CAST(pos AS DOUBLE) * (CAST(cum_neg - neg AS DOUBLE) + CAST(neg AS DOUBLE) / 2e0)) "
        "/ (CAST(max(tot_pos) AS DOUBLE) * CAST(max(tot_neg) AS DOUBLE)) AS auc_roc, "
        "CAST(max(tot_pos) AS BIGINT) AS n_pos, CAST(max(tot_neg) AS BIGINT) AS n_neg FROM asc_cum",
    ),
    (
        "pr_area",
        "SELECT sum((tp - tp0) / P * (prec + CASE WHEN n0 > 0 THEN tp0 / n0 ELSE prec END) / 2e0) AS area_under_pr, "
        "CAST(max(P) AS BIGINT) AS n_pos FROM ("
        "SELECT CAST(tot_pos AS DOUBLE) AS P, CAST(cum_pos AS DOUBLE) AS tp, CAST(cum_pos - pos AS DOUBLE) AS tp0, "
        "CAST(cum_pos AS DOUBLE) / CAST(cum_pos + cum_neg AS DOUBLE) AS prec, CAST(cum_pos + cum_neg - pos - neg AS DOUBLE) AS n0 FROM desc_cum)",
    ),
]
_CTE_INDEX = {name: i for i, (name, _) in enumerate(CTES)}


def _with(body: str, upto: str) -> str:
    """``WITH`` every building block up to and including ``upto``, then ``body``."""
    n = _CTE_INDEX[upto] + 1
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in CTES[:n])
    return f"WITH {ctes}\n{body}"


def _round(sql: str, doubles: list[str]) -> str:
    if not doubles:
        return sql
    rep = ", ".join(f"round({c}, {ROUND}) AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({rep}) FROM ({sql}) AS _r"


TX_DOUBLES = ["tx_amount"]
_FILL_SQL = (
    "SELECT coalesce(transaction_id, 0) AS transaction_id, tx_datetime, coalesce(customer_id, 0) AS customer_id, "
    "coalesce(terminal_id, 0) AS terminal_id, coalesce(tx_amount, 0) AS tx_amount, coalesce(tx_time_seconds, 0) AS tx_time_seconds, "
    "coalesce(tx_time_days, 0) AS tx_time_days, coalesce(tx_fraud, 0) AS tx_fraud, coalesce(tx_fraud_scenario, 0) AS tx_fraud_scenario FROM tx"
)


def _describe_sql() -> str:
    parts = [
        f"SELECT '{c}' AS col_name, count(x) AS count, avg(x) AS mean, stddev_samp(x) AS stddev, min(x) AS min, max(x) AS max "
        f"FROM (SELECT CAST({c} AS DOUBLE) AS x FROM clean)"
        for c in [*FEATURES, LABEL]
    ]
    return _with(" UNION ALL ".join(parts), "clean")


def _profile_sql() -> str:
    types = {f.name: f.dataType.simpleString() for f in TX_SCHEMA.fields}
    parts = [
        f"SELECT '{c}' AS col_name, '{types[c]}' AS data_type, CAST(count(*) AS BIGINT) AS n_rows, "
        f"CAST(count_if({c} IS NULL) AS BIGINT) AS n_null, CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct FROM tx"
        for c in TX_SCHEMA.names
    ]
    return _with(" UNION ALL ".join(parts), "tx")


def _vector_sql(src: str, prefix: str, scaled: bool) -> str:
    if not scaled:
        cols = ", ".join(f"CAST({c} AS DOUBLE) AS {prefix}{c}" for c in FEATURES)
        return f"SELECT transaction_id, {cols} FROM {src}"
    mm = ", ".join(f"min(CAST({c} AS DOUBLE)) AS mn_{c}, max(CAST({c} AS DOUBLE)) AS mx_{c}" for c in FEATURES)
    cols = ", ".join(
        f"CASE WHEN mx_{c} <> mn_{c} THEN (CAST({c} AS DOUBLE) - mn_{c}) * (1e0 / (mx_{c} - mn_{c})) ELSE 0.5e0 END AS {prefix}{c}"
        for c in FEATURES
    )
    return f"SELECT transaction_id, {cols} FROM {src}, (SELECT {mm} FROM train) AS mm"


def oracle_sql() -> dict[str, str]:
    tx_cols = "*"
    s: dict[str, str] = {}
    s["clean_iqr"] = _round(_with("SELECT * FROM clean", "clean"), TX_DOUBLES)
    s["scan_parquet"] = _round(_with(f"SELECT {tx_cols} FROM tx", "tx"), TX_DOUBLES)
    s["scan_csv"] = s["scan_parquet"]
    s["write_parquet"] = s["clean_iqr"]
    s["dedup_rows"] = _round(_with("SELECT * FROM dedup", "dedup"), TX_DOUBLES)
    s["filter_sentinel"] = _round(_with("SELECT * FROM tx WHERE customer_id <> -999999", "tx"), TX_DOUBLES)
    s["drop_null_key"] = _round(_with("SELECT * FROM tx WHERE terminal_id IS NOT NULL", "tx"), TX_DOUBLES)
    s["fill_zero"] = _round(_with(_FILL_SQL, "tx"), TX_DOUBLES)
    s["quantiles"] = _round(
        _with(
            "SELECT CAST(quantile_disc(tx_amount, 0.25) AS DOUBLE) AS p25, CAST(quantile_disc(tx_amount, 0.5) AS DOUBLE) AS p50, "
            "CAST(quantile_disc(tx_amount, 0.75) AS DOUBLE) AS p75 FROM base WHERE tx_amount IS NOT NULL",
            "base",
        ),
        ["p25", "p50", "p75"],
    )
    s["iqr_fences"] = _round(_with("SELECT * FROM fence", "fence"), ["q1", "q3", "iqr", "lower_fence", "upper_fence"])
    s["project_features"] = _round(_with("SELECT customer_id, terminal_id, tx_amount, tx_time_seconds, tx_fraud FROM clean", "clean"), TX_DOUBLES)
    ts = "TRY_CAST(tx_datetime AS TIMESTAMP)"
    s["tx_time_feature"] = _with(
        f"SELECT transaction_id, CAST(hour({ts}) * 3600 + minute({ts}) * 60 + second({ts}) AS INTEGER) AS tx_time FROM tx", "tx"
    )
    s["time_parts"] = _round(
        _with(
            f"SELECT transaction_id, CAST(hour({ts}) AS INTEGER) AS hour_of_day, CAST(minute({ts}) AS INTEGER) AS minute_of_hour, "
            f"CAST(hour({ts}) * 60 + minute({ts}) AS DOUBLE) AS minutes_from_start, "
            f"CAST(hour({ts}) * 3600 + minute({ts}) * 60 + second({ts}) AS INTEGER) AS tx_time_seconds FROM tx",
            "tx",
        ),
        ["minutes_from_start"],
    )
    s["describe"] = _round(_describe_sql(), ["mean", "stddev", "min", "max"])
    s["schema_profile"] = _profile_sql()
    s["flagged"] = _with(
        "SELECT model, CAST(count_if(prediction = 1) AS BIGINT) AS n_flagged, count(*) AS n_rows FROM pred GROUP BY model", "pred"
    )
    cells = (
        "CAST(count_if(tx_fraud = 1 AND prediction = 1) AS BIGINT) AS tp, CAST(count_if(tx_fraud <> 1 AND prediction <> 1) AS BIGINT) AS tn, "
        "CAST(count_if(tx_fraud <> 1 AND prediction = 1) AS BIGINT) AS fp, CAST(count_if(tx_fraud = 1 AND prediction <> 1) AS BIGINT) AS fn"
    )
    s["confusion"] = _with(f"SELECT model, {cells} FROM pred GROUP BY model", "pred")
    s["f1_score"] = _round(
        _with(
            f"SELECT model, tp, tn, fp, fn, CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) END AS precision, "
            f"CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) END AS recall, "
            f"CASE WHEN tp > 0 THEN 2e0 * tp / (2e0 * tp + fp + fn) END AS f1 FROM (SELECT model, {cells} FROM pred GROUP BY model)",
            "pred",
        ),
        ["precision", "recall", "f1"],
    )
    s["rmse"] = _round(
        _with(
            "SELECT model, sqrt(avg((CAST(tx_fraud AS DOUBLE) - prediction) * (CAST(tx_fraud AS DOUBLE) - prediction))) AS rmse, "
            "count(CAST(tx_fraud AS DOUBLE) - prediction) AS n FROM pred GROUP BY model",
            "pred",
        ),
        ["rmse"],
    )
    s["auc_roc"] = _round(_with("SELECT * FROM roc", "roc"), ["auc_roc"])
    s["pr_curve"] = _round(
        _with(
            "SELECT v AS threshold, CAST(cum_pos AS BIGINT) AS tp, CAST(cum_neg AS BIGINT) AS fp, "
            "CAST(cum_pos AS DOUBLE) / CAST(tot_pos AS DOUBLE) AS recall, CAST(cum_pos AS DOUBLE) / CAST(cum_pos + cum_neg AS DOUBLE) AS precision FROM desc_cum",
            "desc_cum",
        ),
        ["threshold", "recall", "precision"],
    )
    s["auc_pr"] = _round(_with("SELECT * FROM pr_area", "pr_area"), ["area_under_pr"])
    kpi = (
            "SELECT model, period, n, n_fraud, n_missed, n_declined, "
            "CASE WHEN n_fraud > 0 THEN CAST(n_missed AS DOUBLE) / n_fraud END AS miss_rate, "
            "CASE WHEN n_good > 0 THEN CAST(n_declined AS DOUBLE) / n_good END AS false_decline_rate, missed_amount, "
            "(CASE WHEN n_fraud > 0 THEN CAST(n_missed AS DOUBLE) / n_fraud END) <= 0.02e0 AS miss_rate_ok, "
            "missed_amount <= 500000e0 AS missed_amount_ok, "
            "(CASE WHEN n_good > 0 THEN CAST(n_declined AS DOUBLE) / n_good END) <= 0.05e0 AS false_decline_ok "
            "FROM (SELECT model, substr(tx_datetime, 1, {length}) AS period, count(*) AS n, "
            "CAST(count_if(tx_fraud = 1) AS BIGINT) AS n_fraud, CAST(count_if(tx_fraud = 1 AND prediction <> 1) AS BIGINT) AS n_missed, "
            "CAST(count_if(tx_fraud <> 1 AND prediction = 1) AS BIGINT) AS n_declined, CAST(count_if(tx_fraud <> 1) AS BIGINT) AS n_good, "
            "coalesce(CAST(sum(CASE WHEN tx_fraud = 1 AND prediction <> 1 THEN CAST(tx_amount AS DECIMAL(18, 6)) END) AS DOUBLE), 0e0) AS missed_amount "
            "FROM scored_all GROUP BY model, substr(tx_datetime, 1, {length}))"
    )
    kpi_doubles = ["miss_rate", "false_decline_rate", "missed_amount"]
    s["kpi_report"] = _round(_with(kpi.format(length=7), "scored_all"), kpi_doubles)
    closed = "CAST(period AS DATE) + 1 <= (SELECT max(CAST(tx_datetime AS TIMESTAMP)) - INTERVAL 30 DAY FROM scored_all)"
    s["kpi_stream"] = _round(_with(f"SELECT * FROM ({kpi.format(length=10)}) WHERE {closed}", "scored_all"), kpi_doubles)
    s["split_hash"] = _with("SELECT transaction_id, part FROM labeled", "labeled")
    s["split_90_10_seed24"] = _with(f"SELECT transaction_id, CASE WHEN {_u(24)} < 0.9e0 THEN 'train' ELSE 'test' END AS part FROM filled", "filled")
    s["split_95_5_seed42"] = _with(f"SELECT transaction_id, CASE WHEN {_u(42)} < 0.95e0 THEN 'train' ELSE 'test' END AS part FROM filled", "filled")
    s["split_groups"] = _with(f"SELECT transaction_id, CASE WHEN {_u(4242)} < 0.5e0 THEN 'A' ELSE 'B' END AS part FROM test", "test")
    s["bootstrap_f1"] = _round(_with("SELECT * FROM samples", "samples"), ["f1"])
    s["f1_interval"] = _round(_with("SELECT * FROM intervals", "intervals"), ["mean", "std", "lo", "hi"])
    s["mann_whitney"] = _round(_with("SELECT * FROM mw", "mw"), ["u1", "u2", "z", "p_value"])
    s["ab_verdict"] = _round(
        _with(
            "SELECT mw.u1, mw.p_value, mw.p_value > 0.05e0 AS same_distribution, a.mean AS mean_a, a.lo AS lo_a, a.hi AS hi_a, "
            "b.mean AS mean_b, b.lo AS lo_b, b.hi AS hi_b, a.n_undefined AS n_undefined_a, b.n_undefined AS n_undefined_b, "
            "CASE WHEN a.mean IS NULL OR b.mean IS NULL THEN 'undefined' WHEN a.hi < b.lo THEN 'B better' WHEN b.hi < a.lo THEN 'A better' ELSE 'undecided' END AS verdict "
            "FROM mw, (SELECT * FROM intervals WHERE model = 'A') AS a, (SELECT * FROM intervals WHERE model = 'B') AS b",
            "mw",
        ),
        ["u1", "p_value", "mean_a", "lo_a", "hi_a", "mean_b", "lo_b", "hi_b"],
    )
    s["ab_verdict_undefined"] = _round(
        _with(
            "SELECT 0e0 AS u1, CAST(NULL AS DOUBLE) AS p_value, CAST(NULL AS BOOLEAN) AS same_distribution, a.mean AS mean_a, a.lo AS lo_a, a.hi AS hi_a, "
            "CAST(NULL AS DOUBLE) AS mean_b, CAST(NULL AS DOUBLE) AS lo_b, CAST(NULL AS DOUBLE) AS hi_b, a.n_undefined AS n_undefined_a, "
            "CAST(50 AS BIGINT) AS n_undefined_b, 'undefined' AS verdict FROM intervals AS a WHERE model = 'A'",
            "intervals",
        ),
        ["u1", "p_value", "mean_a", "lo_a", "hi_a", "mean_b", "lo_b", "hi_b"],
    )
    s["histogram"] = _round(
        _with(
            "SELECT model, CAST(bin AS INTEGER) AS bin, lo + (hi - lo) * bin / 3e0 AS bin_lo, lo + (hi - lo) * (bin + 1) / 3e0 AS bin_hi, "
            "count(*) AS n FROM (SELECT h.model, lo, hi, CASE WHEN hi - lo > 0 THEN least(floor((x - lo) / (hi - lo) * 3e0), 2) ELSE 0 END AS bin "
            "FROM (SELECT model, CAST(f1 AS DOUBLE) AS x FROM samples WHERE f1 IS NOT NULL) AS h "
            "JOIN (SELECT model, min(CAST(f1 AS DOUBLE)) AS lo, max(CAST(f1 AS DOUBLE)) AS hi FROM samples WHERE f1 IS NOT NULL GROUP BY model) AS r "
            "ON h.model = r.model) GROUP BY model, bin, lo, hi",
            "samples",
        ),
        ["bin_lo", "bin_hi"],
    )
    s["ab_paired"] = _with(
        "SELECT CAST(count_if(ca AND cb) AS BIGINT) AS both_right, CAST(count_if(ca AND NOT cb) AS BIGINT) AS only_a_right, "
        "CAST(count_if(NOT ca AND cb) AS BIGINT) AS only_b_right, CAST(count_if(NOT ca AND NOT cb) AS BIGINT) AS both_wrong, "
        "CAST(count_if(pa <> pb) AS BIGINT) AS n_disagree FROM (SELECT (pa = 1) = (tx_fraud = 1) AS ca, (pb = 1) = (tx_fraud = 1) AS cb, pa, pb "
        "FROM (SELECT tx_fraud, CAST(tx_amount > 60.0e0 AS DOUBLE) AS pa, CAST(tx_amount > 30.0e0 AS DOUBLE) AS pb FROM test))",
        "test",
    )
    s["score_batch"] = _with("SELECT * FROM pred", "pred")
    s["assemble"] = _round(_with(_vector_sql("clean", "f_", False), "clean"), [f"f_{c}" for c in FEATURES])
    s["minmax_scale"] = _round(_with(_vector_sql("filled", "s_", True), "train"), [f"s_{c}" for c in FEATURES])
    s["decode_messages"] = _round(_with("SELECT * FROM messages_rows", "messages_rows"), TX_DOUBLES)
    s["stream_bad_rows"] = _round(_with("SELECT * FROM messages_rows WHERE NOT is_valid", "messages_rows"), TX_DOUBLES)
    s["encode_predictions"] = _with("SELECT * FROM encoded", "encoded")
    s["stream_score"] = s["encode_predictions"]
    s["stream_clean"] = s["clean_iqr"]
    s["ml_metrics"] = _round(
        _with(
            "SELECT f.f1_label1, p.area_under_pr, r.auc_roc AS area_under_roc, f.rmse FROM "
            "(SELECT CASE WHEN tp > 0 THEN 2e0 * tp / (2e0 * tp + fp + fn) ELSE 0e0 END AS f1_label1, "
            "sqrt(CAST(fp + fn AS DOUBLE) / n) AS rmse FROM (SELECT count_if(tx_fraud = 1 AND tx_amount > 60.0e0) AS tp, "
            "count_if(tx_fraud <> 1 AND tx_amount > 60.0e0) AS fp, count_if(tx_fraud = 1 AND NOT (tx_amount > 60.0e0)) AS fn, "
            "count(*) AS n FROM filled)) AS f, pr_area AS p, roc AS r",
            "pr_area",
        ),
        ["f1_label1", "area_under_pr", "area_under_roc", "rmse"],
    )
    s["quantiles_sketched"] = _with(
        "SELECT true AS p25, true AS p50, true AS p75, count(tx_amount) AS n_values, count(DISTINCT CASE WHEN tx_amount IS NOT NULL THEN tx_time_days END) AS n_days FROM base", "base"
    )
    s["operating_threshold"] = _round(
        _with(
            "SELECT label, feasible, threshold, f1, tp, fp, fn, miss_rate, false_decline_rate, missed_amount, n_fraud, n_good FROM ("
            "SELECT *, row_number() OVER (PARTITION BY label ORDER BY feasible DESC, CASE WHEN feasible THEN f0 END DESC, v DESC) AS place, "
            "CASE WHEN feasible THEN v END AS threshold, CASE WHEN feasible THEN f0 END AS f1, CASE WHEN feasible THEN tp0 END AS tp, "
            "CASE WHEN feasible THEN fp0 END AS fp, CASE WHEN feasible THEN n_fraud - tp0 END AS fn, CASE WHEN feasible THEN miss0 END AS miss_rate, "
            "CASE WHEN feasible THEN declined0 END AS false_decline_rate, CASE WHEN feasible THEN CAST(all_money - money0 AS DOUBLE) END AS missed_amount "
            "FROM (SELECT *, miss0 <= 0.02e0 AND declined0 <= 0.05e0 AND tp0 > 0 AS feasible, 2e0 * tp0 / (2e0 * tp0 + fp0 + (n_fraud - tp0)) AS f0 "
            "FROM (SELECT *, CAST(n_fraud - tp0 AS DOUBLE) / n_fraud AS miss0, CAST(fp0 AS DOUBLE) / n_good AS declined0 "
            "FROM (SELECT label, v, CAST(sum(pos) OVER w AS BIGINT) AS tp0, CAST(sum(neg) OVER w AS BIGINT) AS fp0, sum(money) OVER w AS money0, "
            "CAST(sum(pos) OVER (PARTITION BY label) AS BIGINT) AS n_fraud, CAST(sum(neg) OVER (PARTITION BY label) AS BIGINT) AS n_good, sum(money) OVER (PARTITION BY label) AS all_money "
            "FROM (SELECT label, v, sum(y) AS pos, sum(1 - y) AS neg, sum(CASE WHEN y = 1 THEN CAST(tx_amount AS DECIMAL(18, 6)) ELSE 0 END) AS money "
            "FROM (SELECT 'planted' AS label, (terminal_id % 8) + tx_amount / 1000e0 AS v, CAST((terminal_id % 8 >= 4) <> (transaction_id % 97 = 0) AS BIGINT) AS y, tx_amount FROM filled "
            "UNION ALL SELECT 'raw' AS label, tx_amount AS v, CAST(tx_fraud AS BIGINT) AS y, tx_amount FROM filled) GROUP BY label, v) "
            "WINDOW w AS (PARTITION BY label ORDER BY v DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))))) WHERE place = 1",
            "filled",
        ),
        ["threshold", "f1", "miss_rate", "false_decline_rate", "missed_amount"],
    )
    s["bootstrap_f1_cells"] = _round(
        _with(
            "SELECT model, replicate, CAST(tp + tn + fp + fn AS BIGINT) AS n, tp, fp, fn, CASE WHEN tp > 0 THEN 2e0 * tp / (2e0 * tp + fp + fn) END AS f1 FROM ("
            "SELECT model, replicate, CAST(sum(CASE WHEN cell = 'tp' THEN draw END) AS BIGINT) AS tp, CAST(sum(CASE WHEN cell = 'tn' THEN draw END) AS BIGINT) AS tn, "
            "CAST(sum(CASE WHEN cell = 'fp' THEN draw END) AS BIGINT) AS fp, CAST(sum(CASE WHEN cell = 'fn' THEN draw END) AS BIGINT) AS fn FROM ("
            "SELECT model, replicate, cell, CASE WHEN any_value(mean) < 64e0 THEN count_if(cdf <= u) "
            "ELSE greatest(0, CAST(floor(any_value(mean) + sqrt(any_value(mean)) * any_value(z) + (any_value(z) * any_value(z) - 1e0) / 6e0 + 0.5e0) AS BIGINT)) END AS draw "
            "FROM (SELECT model, replicate, cell, mean, u, z, k, sum(CASE WHEN mean = 0 THEN CAST(k = 0 AS INTEGER) ELSE exp(k * ln(greatest(mean, 1e-300)) - mean - lgamma(k + 1)) END) "
            "OVER (PARTITION BY model, replicate, cell ORDER BY k) AS cdf "
            "FROM (SELECT *, sqrt(-2e0 * ln(u + 0.5e0 / 4294967296e0)) * cos(2e0 * pi() * u2) AS z FROM ("
            "SELECT model, replicate, cell, size * 0.8e0 AS mean, "
            "CAST(('0x' || substr(h, 1, 8)) AS BIGINT) / 4294967296e0 AS u, CAST(('0x' || substr(h, 9, 8)) AS BIGINT) / 4294967296e0 AS u2 "
            "FROM (SELECT c.model, CAST(r.replicate AS INTEGER) AS replicate, c.cell, c.size, md5('42:' || c.model || ':' || r.replicate || ':' || c.cell) AS h "
            "FROM (SELECT model, cell, CAST(sum(CASE cell WHEN 'tp' THEN CAST(tx_fraud = 1 AND prediction = 1 AS INTEGER) WHEN 'tn' THEN CAST(tx_fraud <> 1 AND prediction <> 1 AS INTEGER) "
            "WHEN 'fp' THEN CAST(tx_fraud <> 1 AND prediction = 1 AS INTEGER) ELSE CAST(tx_fraud = 1 AND prediction <> 1 AS INTEGER) END) AS DOUBLE) AS size "
            "FROM pred, (VALUES ('tp'), ('tn'), ('fp'), ('fn')) AS n(cell) GROUP BY model, cell) AS c, range(0, 50) AS r(replicate)))), range(0, 200) AS t(k)) "
            "GROUP BY model, replicate, cell) GROUP BY model, replicate)",
            "pred",
        ),
        ["f1"],
    )
    few = "SELECT model, f1 AS v FROM samples WHERE replicate < 8 AND f1 IS NOT NULL"
    s["mann_whitney_exact"] = _round(
        _with(
            f"SELECT n1, n2, u1, n1 * n2 - u1 AS u2, (greatest(u1, n1 * n2 - u1) - n1 * n2 / 2e0 - 0.5e0) / "
            "sqrt(n1 * n2 / 12e0 * ((n1 + n2 + 1e0) - ties / ((n1 + n2) * (n1 + n2 - 1e0)))) AS z, "
            "CASE WHEN ties = 0 THEN least(1e0, 2e0 * (SELECT count_if(w >= greatest(u1, n1 * n2 - u1)) / CAST(count(*) AS DOUBLE) FROM ("
            "SELECT list_sum([CASE WHEN (m >> i) & 1 = 1 THEN i + 1 ELSE 0 END for i in range(0, 16)]) - n1 * (n1 + 1) / 2 AS w FROM range(0, 65536) AS t(m) "
            "WHERE bit_count(m) = n1 AND m < (1 << CAST(n1 + n2 AS BIGINT))))) END AS p_value FROM ("
            f"SELECT (SELECT count(*) FROM ({few}) WHERE model = 'A') AS n1, (SELECT count(*) FROM ({few}) WHERE model = 'B') AS n2, "
            f"(SELECT coalesce(sum(CASE WHEN a.v > b.v THEN 1e0 WHEN a.v = b.v THEN 0.5e0 ELSE 0e0 END), 0e0) FROM ({few}) AS a, ({few}) AS b WHERE a.model = 'A' AND b.model = 'B') AS u1, "
            f"(SELECT coalesce(sum(CAST(c AS DOUBLE) * c * c - c), 0e0) FROM (SELECT count(*) AS c FROM ({few}) GROUP BY v)) AS ties)",
            "samples",
        ),
        ["u1", "u2", "z", "p_value"],
    )
    s["mcnemar"] = _round(
        _with(
            "SELECT only_a_right, only_b_right, CASE WHEN n = 0 THEN 1e0 ELSE least(1e0, 2e0 * (SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) - n * ln(2e0))) "
            "FROM range(0, 1000000) AS t(i) WHERE i <= least(only_a_right, only_b_right))) END AS p_exact, statistic, "
            f"CASE WHEN n > 0 THEN least(1e0, {_ERFC}) END AS p_asymptotic FROM (SELECT *, 1e0 / (1e0 + 0.5e0 * x) AS t FROM (SELECT *, sqrt(statistic) / sqrt(2e0) AS x FROM ("
            "SELECT *, CASE WHEN n > 0 THEN greatest(abs(only_a_right - only_b_right) - 1e0, 0e0) ** 2 / n END AS statistic FROM ("
            "SELECT *, only_a_right + only_b_right AS n FROM (SELECT CAST(count_if(ca AND NOT cb) AS BIGINT) AS only_a_right, CAST(count_if(NOT ca AND cb) AS BIGINT) AS only_b_right "
            "FROM (SELECT (tx_amount > 60.0e0) = (tx_fraud = 1) AS ca, (tx_amount > 62.0e0) = (tx_fraud = 1) AS cb FROM test))))))",
            "test",
        ),
        ["p_exact", "statistic", "p_asymptotic"],
    )
    s["quantiles_approx_within"] = "SELECT true AS p25, true AS p50, true AS p75"
    rule = "CAST(terminal_id % 8 >= 4 AS INTEGER) AS tx_fraud, CAST(terminal_id % 8 >= 4 AS DOUBLE) AS prediction"
    for name in ("train_rf", "train_rf_baseline", "train_gbt"):
        s[name] = _with(f"SELECT transaction_id, {rule} FROM test", "test")
    s["train_dt_ab"] = _with(f"SELECT model, transaction_id, {rule} FROM test, (VALUES ('A'), ('B')) AS m(model)", "test")
    s["model_roundtrip"] = _with(f"SELECT transaction_id, {rule}, true AS same FROM test", "test")
    s["importances"] = (
        "SELECT 'rf' AS model, feature, feature = 'terminal_id' AS is_top, 1e0 AS total "
        "FROM (VALUES ('customer_id'), ('terminal_id'), ('tx_amount'), ('tx_time_seconds')) AS f(feature)"
    )
    trial = (
        "'{\"impurity\": \"' || impurity || '\", \"maxDepth\": ' || max_depth || ', \"numTrees\": ' || num_trees || '}' AS params, "
        "CAST(num_trees AS INTEGER) AS num_trees, CAST(max_depth AS INTEGER) AS max_depth, impurity"
    )
    s["tune_grid"] = (
        f"SELECT 'grid' AS method, CAST(trial AS INTEGER) AS trial, {trial}, 'areaUnderROC' AS metric, max_depth = 7 AS reached, trial = 1 AS is_best "
        "FROM (VALUES (0, 100, 2, 'gini'), (1, 100, 7, 'gini'), (2, 200, 2, 'gini'), (3, 200, 7, 'gini')) AS t(trial, num_trees, max_depth, impurity)"
    )

    def draws(method: str, n: int, trees: str, depths: str) -> str:
        points = (
            "SELECT round, num_trees, max_depth, impurity FROM range(0, 9) AS r(round), "
            f"(SELECT unnest({trees}) AS num_trees), (SELECT unnest({depths}) AS max_depth), (VALUES ('gini'), ('entropy')) AS i(impurity)"
        )
        drawn = (
            "SELECT *, row_number() OVER (ORDER BY round, md5('42:' || round || ':' || num_trees || ':' || max_depth || ':' || impurity)) - 1 AS trial "
            f"FROM ({points}) QUALIFY trial < {n}"
        )
        return f"SELECT '{method}' AS method, CAST(trial AS INTEGER) AS trial, {trial}, 'areaUnderPR' AS metric, true AS reached, trial = 0 AS is_best FROM ({drawn})"

    s["tune_random"] = draws("random", 50, "[100, 200, 300, 400]", "[2, 3, 4, 5, 6, 7, 8, 9, 10]")
    s["tune_cv"] = draws("cv", 40, "[100, 200, 300]", "[2, 3, 4, 5, 6]")
    s["best_params"] = "SELECT 'best' AS model, * FROM (VALUES ('numTrees', '40'), ('maxDepth', '7'), ('impurity', 'gini'), ('seed', '42')) AS p(param, value)"
    s["best_params_grid"] = "SELECT 'best' AS model, * FROM (VALUES ('numTrees', '100'), ('maxDepth', '7'), ('impurity', 'gini'), ('seed', '42')) AS p(param, value)"
    s["run_log"] = (
        "SELECT 'dt_md7' AS run, * FROM (VALUES ('param', 'features', '[\"customer_id\", \"terminal_id\", \"tx_amount\", \"tx_time_seconds\"]'), "
        "('param', 'maxDepth', '7'), ('param', 'seed', '42'), ('metric', 'areaUnderPR', '1.0'), ('metric', 'f1', '1.0')) AS r(kind, key, value)"
    )
    return s
