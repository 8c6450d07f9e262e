"""User-level jobs: clean, train, A/B validate, stream score.

Each job is a plain function over a session and paths; a scheduler (cron,
Airflow, ...) only needs to call it. Shared building blocks used by the jobs
and by the query catalog live here too.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txsentry.operators import abtest, clean as cl, metrics, ml, sampling, sketches
from txsentry.session import ensure_conf, scratch_dir, scratch_path, scratch_scope
from txsentry.sources import files
from txsentry.sources.tables import FEATURES, ID, LABEL, TX_SCHEMA
from txsentry.streaming import score as st

# The split used for training and validation (90 / 10, seed 42) and
# the bootstrap of the A/B test (50 replicates of 0.8 x rows).
SPLIT_WEIGHTS = [0.9, 0.1]
SPLIT_SEED = 42
BOOT_REPLICATES = 50
BOOT_RATE = 0.8

NUMERIC_COLUMNS = [f.name for f in TX_SCHEMA.fields if f.dataType.typeName() != "string"]

# Deterministic rule models used where results must be reproducible in SQL.
RULE_A_THRESHOLD = 60.0
RULE_B_THRESHOLD = 30.0


def train_test(df: DataFrame, weights: list[float] | None = None, seed: int = SPLIT_SEED, key: str = ID) -> tuple[DataFrame, DataFrame]:
    train, test = sampling.split_hash(df, weights or SPLIT_WEIGHTS, key=key, seed=seed)
    return train, test


def with_key(df: DataFrame) -> DataFrame:
    """A row without a key gets a negative one, a hash of all its columns: the split, the
    bootstrap and the sketches hash the key, and such rows spread like others. To be called
    on whole rows, before columns are dropped or filled, so that a row has one key everywhere."""
    alone = -F.shiftrightunsigned(F.xxhash64(*df.columns), 1)
    return df.withColumn(ID, F.coalesce(F.col(ID), alone))


def prepared(df: DataFrame) -> DataFrame:
    """Clean rows as both the training and the validation job read them: rows without a key get
    one (``with_key``; rows that have been through it keep theirs), NULL numbers become 0."""
    if ID in df.columns:
        df = with_key(df)
    return df.fillna(0, subset=[c for c in df.columns if c != ID and c in NUMERIC_COLUMNS])


def predictions_ab(test: DataFrame, model_a: PipelineModel, model_b: PipelineModel) -> DataFrame:
    """Long prediction table (model, id, label, prediction) for two models on the same
    rows. Both models score one scan of the rows (B on A's output), and the pair is
    unpivoted in the same stage: a union of two scorings would read the rows twice."""
    sb = side_by_side(test, model_a, model_b)
    pairs = F.array(
        F.struct(F.lit("A").alias("model"), F.col("prediction_a").alias("prediction")),
        F.struct(F.lit("B").alias("model"), F.col("prediction_b").alias("prediction")),
    )
    return sb.select(ID, LABEL, F.inline(pairs)).select("model", ID, LABEL, "prediction")


def side_by_side(test: DataFrame, model_a: PipelineModel, model_b: PipelineModel) -> DataFrame:
    """Both predictions in one row per transaction: B transforms A's output, no join."""
    a = model_a.transform(test).withColumnRenamed("prediction", "prediction_a")
    keep = [c for c in a.columns if c not in ("score", "rawPrediction", "probability", "features", "scaledFeatures")]
    b = model_b.transform(a.select(*keep)).withColumnRenamed("prediction", "prediction_b")
    return b.select(ID, LABEL, "prediction_a", "prediction_b")


# --- jobs ---------------------------------------------------------------------


def clean_job(spark: SparkSession, src: str, dst: str, sentinel: int = cl.SENTINEL_CUSTOMER, method: str = "exact", rel_error: float = 0.05, raw_copy: str | None = None, fmt: str = "csv") -> DataFrame:
    """Raw CSV (or Parquet) -> optional raw Parquet copy -> clean -> Parquet at ``dst``.
    Staged copies are removed at the end, also after a failure."""
    ensure_conf(spark)
    with scratch_scope():
        raw = files.read_csv(spark, src) if fmt == "csv" else files.read_parquet(spark, src)
        if raw_copy:
            files.write_parquet(raw, raw_copy)
            raw = files.read_parquet(spark, raw_copy)
        out = cl.clean(raw, sentinel=sentinel, method=method, rel_error=rel_error, stage_path=scratch_path(spark, "clean-stage"))
        files.write_parquet(out, dst)
    return files.read_parquet(spark, dst)


def clean_run_job(spark: SparkSession, src: str, dst: str, sketch_path: str, run: str, sentinel: int = cl.SENTINEL_CUSTOMER, keep_days: int | None = None, k: float = 1.5, fmt: str = "csv") -> DataFrame:
    """One run of the job that cleans every few minutes: the new rows at ``src`` only, with a fence
    from all days' stored sketches (``keep_days``: only those so near to the newest day) and
    this run's, merged. Old rows are not read. The run's clean rows go to ``dst/run=<run>``,
    its sketches to ``sketch_path``; a repeated run replaces both. Copies are dropped within the
    run; a run without any stored value keeps no row, as there is no fence."""
    ensure_conf(spark)
    with scratch_scope():
        raw = files.read_csv(spark, src) if fmt == "csv" else files.read_parquet(spark, src)
        base = cl.drop_null_key(cl.filter_sentinel(cl.dedup_rows(raw), sentinel=sentinel))
        base = files.materialize(base, scratch_path(spark, "clean-run"))
        sketches.store(sketches.day_sketches(base, "tx_amount"), sketch_path, run)
        held = sketches.stored(spark, sketch_path)
        if keep_days is not None:
            newest = held.agg(F.max("day").alias("d")).select("d").scalar()
            held = held.filter(F.col("day") > newest - F.lit(keep_days))
        quartiles = sketches.quantiles_from(held, [0.25, 0.75]).select(F.col("q0").alias("q1"), F.col("q1").alias("q3"))
        fence = cl.fences_of(quartiles, k).select("upper_fence").scalar()
        out = f"{dst.rstrip('/')}/run={run}"
        cl.apply_upper_fence(base, "tx_amount", fence).write.mode("overwrite").parquet(out)
    return files.read_parquet(spark, out)


# The training job's own split (95 / 5).
TRAIN_WEIGHTS = [0.95, 0.05]


def train_job(
    spark: SparkSession,
    src: str,
    model_dir: str,
    params: dict | None = None,
    run_log: str | None = None,
    run: str = "rf",
    random_state: int = SPLIT_SEED,
    weights: list[float] | None = None,
) -> tuple[PipelineModel, dict]:
    """Clean Parquet -> split by ``weights`` and ``random_state`` -> assembler/scaler/
    forest on the training part -> F1 and area under PR on the test part -> model files
    (+ run log rows: features, split, parameters, metrics)."""
    ensure_conf(spark)
    scratch_dir(spark)  # the checkpoint folder the tree learner checkpoints into
    with scratch_scope():
        df = prepared(files.read_parquet(spark, src))
        weights = weights or TRAIN_WEIGHTS
        train, test = train_test(df, weights, random_state)
        p = {**ml.RF_JOB_PARAMS, "seed": random_state, **(params or {})}
        model = ml.fit_forest(ml.rf_pipeline(**p), train)
        scored = files.materialize(ml.score(model, test), scratch_path(spark, "train-scored"))
        auc = metrics.auc_pr(scored, score="p_fraud").first()["area_under_pr"]
        f1 = metrics.f1_score(scored).first()["f1"]
        ml.save_model(model, model_dir)
    nan = float("nan")
    result = {"areaUnderPR": nan if auc is None else float(auc), "f1": nan if f1 is None else float(f1)}
    if run_log:
        ml.log_run(spark, run_log, run, {"features": FEATURES, "split": weights, **p}, result)
    return model, result


def ab_job(spark: SparkSession, src: str, model_a: str | PipelineModel, model_b: str | PipelineModel, reps: int = BOOT_REPLICATES, rate: float = BOOT_RATE, alpha: float = 0.05, random_state: int = SPLIT_SEED, weights: list[float] | None = None) -> DataFrame:
    """Score the test part with both models once, bootstrap F1 in one pass, then the
    interval, the U test and the verdict (one row)."""
    ensure_conf(spark)
    df = prepared(files.read_parquet(spark, src))
    _, test = train_test(df, weights, random_state)
    ma = ml.load_model(model_a) if isinstance(model_a, str) else model_a
    mb = ml.load_model(model_b) if isinstance(model_b, str) else model_b
    samples = sampling.bootstrap_f1(predictions_ab(test, ma, mb), reps, rate, by=["model"])
    return abtest.ab_verdict(samples, alpha=alpha)


def score_stream_job(spark: SparkSession, source_opts: dict, sink_opts: dict, bad_opts: dict, model_dir: str, checkpoint: str, trigger: str | None = None, outbox: str | None = None):
    """Kafka in -> scores -> Kafka out. ``source_opts`` / ``sink_opts`` / ``bad_opts`` need
    ``bootstrap`` and ``topic``; other keys are passed as Kafka options. Rows that cannot
    be scored go to the topic of ``bad_opts``. Answers go through the outbox table at ``outbox``
    (default: ``outbox`` in the checkpoint folder), so that a restart does not repeat them."""
    ensure_conf(spark)
    so = dict(source_opts)
    msgs = st.kafka_source(spark, so.pop("bootstrap"), so.pop("topic"), so)
    ko = dict(sink_opts)
    sink = st.outbox_sink(outbox or f"{checkpoint.rstrip('/')}/outbox", st.kafka_sender(ko.pop("bootstrap"), ko.pop("topic", "predicted"), ko))
    bo = dict(bad_opts)
    bad = st.bad_rows_kafka_sink(bo.pop("bootstrap"), bo.pop("topic"), bo)
    return st.score_stream(msgs, ml.load_model(model_dir), sink, bad, checkpoint, processing_time=trigger)
