"""A model handed to a running stream, and the goals of a stream's closed windows."""

import json

import pytest
from pyspark.sql import functions as F

from tests.test_outbox import Receiver
from txsentry.operators import ml
from txsentry.sources import files
from txsentry.streaming import handover
from txsentry.streaming import messages as msg
from txsentry.streaming import score as st


def frame(spark, numbers):
    values = [(("data", 0, i, f'[[{i}, "2024-02-07 11:59:44", 5, 9, 50.0]]')) for i in numbers]
    return spark.createDataFrame(values, msg.MESSAGE_SCHEMA)


def run(spark, tmp_path, sink):
    src = st.file_message_source(spark, str(tmp_path / "src"), max_files=1)
    model = handover.current_model(str(tmp_path / "registry"), "scoring")
    st.score_stream(src, model, sink, st.bad_rows_parquet_sink(str(tmp_path / "bad")), str(tmp_path / "ck"), available_now=True).awaitTermination()


def test_pointer_changes_between_epochs_and_a_replay_keeps_its_version(spark, tmp_path):
    root, src = str(tmp_path / "registry"), str(tmp_path / "src")
    with pytest.raises(ValueError):
        handover.current_version(spark, root)
    handover.publish(spark, root, ml.rule_model(60.0), "v1")
    files.write_parquet(frame(spark, range(3)).coalesce(1), src)
    sink = st.parquet_batch_sink(str(tmp_path / "out"))
    run(spark, tmp_path, sink)
    handover.publish(spark, root, ml.rule_model(40.0), "v2")
    frame(spark, range(3, 6)).coalesce(1).write.mode("append").parquet(src)

    def fails(batch, epoch):
        raise ConnectionError("down")

    with pytest.raises(Exception, match="down"):
        run(spark, tmp_path, fails)  # the epoch has begun with v2
    handover.make_current(spark, root, "v1")
    run(spark, tmp_path, sink)  # replayed: still v2
    frame(spark, range(6, 8)).coalesce(1).write.mode("append").parquet(src)
    run(spark, tmp_path, sink)
    got = {r["offset"]: (json.loads(r["value"]), r["model_version"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {i: ({str(i): float(3 <= i < 6)}, "v2" if 3 <= i < 6 else "v1") for i in range(8)}
    with pytest.raises(ValueError):
        handover.make_current(spark, root, "v3")
    with pytest.raises(Exception):
        handover.publish(spark, root, ml.rule_model(1.0), "v2")


def test_outbox_carries_the_version(spark, tmp_path):
    handover.publish(spark, str(tmp_path / "registry"), ml.rule_model(40.0), "v7")
    files.write_parquet(frame(spark, range(5)), str(tmp_path / "src"))
    versions = []
    receiver = Receiver()

    def send(answers):
        receiver(answers)
        versions.extend(r["model_version"] for r in answers.collect())

    run(spark, tmp_path, st.outbox_sink(str(tmp_path / "box"), send))
    assert sum(receiver.got.values()) == 5 and versions == ["v7"] * 5


def test_kpi_windows_close_once_and_late_rows_are_counted(spark, tmp_path):
    def rows(*pairs):
        return spark.createDataFrame([(f"2024-01-{d:02d} 10:00:00", y, float(p), 10.0) for d, y, p in pairs], "tx_datetime string, tx_fraud int, prediction double, tx_amount double").coalesce(1)

    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    late = 0
    for batch in (rows((1, 1, 0), (1, 0, 1), (2, 1, 1)), rows((2, 0, 0), (1, 1, 1), (5, 1, 0)), rows((1, 1, 0), (5, 0, 0), (9, 0, 0))):
        batch.write.mode("append").parquet(src)
        stream = st.kpi_stream(spark.readStream.schema(batch.schema).parquet(src), "1 day", "2 days")
        q = stream.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start()
        q.awaitTermination()
        late += sum(s["numRowsDroppedByWatermark"] for p in q.recentProgress for s in p["stateOperators"])
    got = {r["d"]: (r["n"], r["n_fraud"], r["n_missed"], r["n_declined"], r["missed_amount"]) for r in spark.read.parquet(out).withColumn("d", F.dayofmonth("window_start")).collect()}
    assert got == {1: (3, 2, 1, 1, 10.0), 2: (2, 1, 0, 0, 0.0), 5: (2, 1, 1, 0, 10.0)} and late == 1
