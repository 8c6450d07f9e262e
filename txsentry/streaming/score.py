"""Structured Streaming jobs: score incoming messages, clean a transaction stream.

Sources: Kafka (options from the caller; the connector jar must be on the
classpath) or, for tests and replays, a file source with the same columns
(topic, partition, offset, value). Sinks: Kafka or Parquet through
``foreachBatch``. Progress lives in the checkpoint folder, so a restarted
query continues where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txsentry.operators.clean import SENTINEL_CUSTOMER
from txsentry.operators import metrics
from txsentry.operators.features import with_tx_time
from txsentry.session import mark_path, path_exists
from txsentry.sources.tables import TX_COLUMNS, TX_SCHEMA
from txsentry.streaming.handover import Scorer
from txsentry.streaming.messages import MESSAGE_SCHEMA, MSG_KEY, decode_messages, encode_predictions
from txsentry.streaming.seen import first_rows, start_with_rocksdb


def kafka_source(spark: SparkSession, bootstrap: str, topic: str, options: dict[str, str] | None = None, starting: str = "latest") -> DataFrame:
    """Kafka messages as (topic, partition, offset, value string). Security options
    (SASL, SSL, credentials) come from the caller."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load().select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))


def file_message_source(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Messages replayed from Parquet files with the Kafka source's columns."""
    r = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.parquet(path)


def scored_rows(msgs: DataFrame, model: PipelineModel) -> DataFrame:
    """Decoded valid rows with features and the model's prediction."""
    return model.transform(with_tx_time(decode_messages(msgs).filter("is_valid")))


def parquet_batch_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Write each micro-batch's messages under its epoch; a replayed epoch overwrites
    its own folder, so the sink holds each epoch once."""

    def write(batch: DataFrame, epoch: int) -> None:
        encode_predictions(batch).write.mode("overwrite").parquet(f"{path.rstrip('/')}/epoch={epoch}")

    return write


def kafka_batch_sink(bootstrap: str, topic: str = "predicted", options: dict[str, str] | None = None) -> Callable[[DataFrame, int], None]:
    """Send each micro-batch's answers at once. At least once: an epoch that is replayed after a
    failure is sent again as a whole; ``outbox_sink`` avoids that."""

    def write(batch: DataFrame, epoch: int) -> None:
        w = encode_predictions(batch).select(F.col("value")).write.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("topic", topic)
        for k, v in (options or {}).items():
            w = w.option(k, v)
        w.save()

    return write


def kafka_sender(bootstrap: str, topic: str = "predicted", options: dict[str, str] | None = None) -> Callable[[DataFrame], None]:
    """Send answers to a topic; the message's place is the Kafka key, by which a reader can
    tell an answer that was sent twice."""

    def send(answers: DataFrame) -> None:
        w = answers.select(F.concat_ws(":", *MSG_KEY).alias("key"), "value").write.format("kafka")
        w = w.option("kafka.bootstrap.servers", bootstrap).option("topic", topic)
        for k, v in (options or {}).items():
            w = w.option(k, v)
        w.save()

    return send


def outbox_sink(path: str, send: Callable[[DataFrame], None], slices: int = 8) -> Callable[[DataFrame, int], None]:
    """A sink for a receiver without transactions, by an outbox table at ``path`` (one per
    query, on storage that survives a restart).

    The answers of an epoch are written first, dealt into ``slices`` by a hash of the message,
    and then sent slice by slice, each marked when ``send`` has returned. A replayed epoch
    finds its answers written (they are not computed again, so they are the same even if the
    model has changed since) and sends only the slices without a mark. So after a failure
    between slices every message is answered once; a failure inside ``send`` can repeat that
    slice's answers only.
    """
    box = path.rstrip("/")

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        place, marks = f"{box}/answers/epoch={epoch}", f"{box}/marks/epoch={epoch}"
        dealt = encode_predictions(batch).withColumn("slice", F.pmod(F.xxhash64(*MSG_KEY), F.lit(slices)).cast("int"))
        if not path_exists(spark, f"{marks}/written"):
            dealt.write.mode("overwrite").partitionBy("slice").parquet(place)
            mark_path(spark, f"{marks}/written")
        held = spark.read.schema(dealt.schema).parquet(place)
        for i in range(slices):
            if not path_exists(spark, f"{marks}/sent-{i}"):
                send(held.filter(F.col("slice") == i).drop("slice"))
                mark_path(spark, f"{marks}/sent-{i}")

    return write


def bad_rows_parquet_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Write each micro-batch's invalid rows under its epoch."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/epoch={epoch}")

    return write


def bad_rows_kafka_sink(bootstrap: str, topic: str, options: dict[str, str] | None = None) -> Callable[[DataFrame, int], None]:
    """Send each invalid row, as JSON with its message's place, to a topic of its own."""

    def write(batch: DataFrame, epoch: int) -> None:
        w = batch.select(F.to_json(F.struct(*batch.columns)).alias("value")).write.format("kafka")
        w = w.option("kafka.bootstrap.servers", bootstrap).option("topic", topic)
        for k, v in (options or {}).items():
            w = w.option(k, v)
        w.save()

    return write


def score_stream(
    msgs: DataFrame,
    model: PipelineModel | Scorer,
    sink: Callable[[DataFrame, int], None],
    bad_sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    available_now: bool = False,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the scoring query: decode -> features -> model -> one JSON map per message.
    Rows that cannot be scored (malformed message, missing or malformed model input) go
    to ``bad_sink`` with their message's place, so no row of the input vanishes; a message
    without any valid row has no answer but its rows there. Grouping by message happens
    per micro-batch (a message never spans batches), so no streaming state is kept.

    ``model`` may be a function of (session, epoch) that gives a model and its version
    (``handover.current_model``): it is asked once per epoch, and every answer carries the
    version in ``model_version``."""
    decoded = decode_messages(msgs)

    def each(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            rows = with_tx_time(batch.filter("is_valid"))
            if callable(model):
                chosen, version = model(batch.sparkSession, epoch)
                good = chosen.transform(rows).withColumn("model_version", F.lit(version))
            else:
                good = model.transform(rows)
            sink(good, epoch)
            bad_sink(batch.filter(~F.col("is_valid")), epoch)
        finally:
            batch.unpersist()

    w = decoded.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def tx_file_source(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(TX_SCHEMA)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.parquet(path)


def _clean_rows(tx: DataFrame, upper_fence: float, sentinel: int, key_cols: list[str] | None) -> DataFrame:
    cond = F.col("customer_id") != F.lit(sentinel)
    for c in key_cols or ["terminal_id"]:
        cond = cond & F.col(c).isNotNull()
    return tx.filter(cond & (F.col("tx_amount") <= F.lit(float(upper_fence))))


def clean_stream(
    tx: DataFrame,
    upper_fence: float,
    delay: str = "1 hour",
    sentinel: int = SENTINEL_CUSTOMER,
    key_cols: list[str] | None = None,
) -> DataFrame:
    """Streaming form of the cleaning job with bounded state, for rows in time order.

    Duplicates are dropped within the watermark: state is kept for ``delay`` of event
    time. Spark drops every row older than the watermark, copy or not, and a row whose
    time is malformed has no event time; where such rows must be kept, use
    ``clean_stream_to``, which drops none. The fence is fixed, computed by the batch
    job: quantiles of an unbounded stream are not defined.
    """
    # The filters test one row at a time and copies are identical rows, so they
    # commute with the full-row dedup; filtering first keeps rejected rows out of
    # the dedup state.
    ts = F.col("tx_datetime").try_cast("timestamp")
    s = _clean_rows(tx, upper_fence, sentinel, key_cols).withColumn("_event_ts", ts).withWatermark("_event_ts", delay)
    return s.dropDuplicatesWithinWatermark(TX_COLUMNS).drop("_event_ts")


#: How far (event days) a row may lie behind the newest of its bucket, and into how many
#: buckets rows are dealt. A bucket's day should hold some ten thousand rows at most.
HORIZON_DAYS = 400
BUCKETS = 16


def clean_stream_to(
    tx: DataFrame,
    path: str,
    upper_fence: float,
    checkpoint: str,
    sentinel: int = SENTINEL_CUSTOMER,
    key_cols: list[str] | None = None,
    available_now: bool = False,
    processing_time: str | None = None,
    horizon_days: int = HORIZON_DAYS,
    buckets: int = BUCKETS,
    late_path: str | None = None,
) -> StreamingQuery:
    """Streaming clean that keeps rows out of time order: the result equals the batch job's,
    whatever the order of arrival, as long as no row lies more than ``horizon_days`` behind
    the newest of its bucket. Rows beyond that go to ``late_path`` (default: beside the sink,
    ``<path>-late``), so none vanishes.

    Which rows have been seen is keyed state in the checkpoint (``streaming.seen``), bounded by
    the horizon; the sink is never read. A replayed epoch overwrites its own folder.
    ``buckets`` is fixed for the life of a checkpoint.
    """
    place, late_place = path.rstrip("/"), (late_path or f"{path.rstrip('/')}-late").rstrip("/")
    # filters test one row at a time and copies are identical rows: rejected rows need no state
    rows = first_rows(_clean_rows(tx, upper_fence, sentinel, key_cols).select(TX_COLUMNS), TX_SCHEMA, "tx_datetime", horizon_days, buckets)

    def each(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            for late, to in ((False, place), (True, late_place)):
                batch.filter(F.col("is_late") == F.lit(late)).drop("is_late").write.mode("overwrite").parquet(f"{to}/epoch={epoch}")
        finally:
            batch.unpersist()

    w = rows.writeStream.foreachBatch(each).outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return start_with_rocksdb(tx.sparkSession, w.start)


def kpi_stream(scored: DataFrame, window: str = "1 day", delay: str = "1 hour", by: list[str] | None = None, **goals) -> DataFrame:
    """The business goals (``metrics.kpi_report``) per event-time window of a stream of scored
    rows, for an append sink: a window's one row comes out when the watermark (the latest
    event time less ``delay``) has passed its end, and is final. Rows that come later than
    that are dropped by the engine; its progress report counts them. Rows without a readable
    time belong to no window. State: one row per group and open window."""
    timed = scored.withColumn("_event_ts", F.col("tx_datetime").try_cast("timestamp")).withWatermark("_event_ts", delay)
    out = metrics.kpi_report(timed, by=by, period=F.window("_event_ts", window), **goals)
    return out.withColumn("window_start", F.col("period.start")).withColumn("window_end", F.col("period.end")).drop("period")
