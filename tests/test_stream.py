import json

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL, row, tx_rows
from txsentry.operators import clean as cl
from txsentry.operators import ml
from txsentry.plans import catalog
from txsentry.session import scratch_path
from txsentry.sources import files
from txsentry.streaming import messages as msg
from txsentry.streaming import score as st


def messages(spark, values):
    rows = [("data", 0, i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, msg.MESSAGE_SCHEMA)


def test_decode_bad_messages(spark):
    df = messages(
        spark,
        [
            '[[1510422185, "2024-02-07 11:59:44.123456", 5, 9, 70.25], [1510422186, "2024-02-07 11:59:44.123460", 6, 9, 12]]',
            '[[7, "not a date", 1, 1, 1.0], [8, "2024-02-07 00:00:00", 1]]',
            "not json",
        ],
    )
    got = {(r["offset"], r["pos"]): r for r in msg.decode_messages(df).collect()}
    assert got[(0, 0)]["is_valid"] and got[(0, 0)]["tx_amount"] == 70.25
    assert got[(0, 1)]["is_valid"] and got[(0, 1)]["tx_amount"] == 12.0  # integer amount accepted
    assert not got[(1, 0)]["is_valid"]  # bad date
    assert not got[(1, 1)]["is_valid"] and got[(1, 1)]["tx_amount"] is None  # short row
    assert not got[(2, None)]["is_valid"]  # not JSON


def test_encode_repeated_id_last_wins(spark):
    df = messages(spark, ['[[1, "2024-02-07 11:59:44", 5, 9, 100.0], [2, "2024-02-07 11:59:45", 5, 9, 1.0], [1, "2024-02-07 11:59:46", 5, 9, 1.0]]'])
    rows = msg.decode_messages(df).filter("is_valid")
    out = msg.encode_predictions(ml.rule_model(60.0).transform(rows)).first()
    assert json.loads(out["value"]) == {"1": 0.0, "2": 0.0}
    assert out["value"] == '{"1":0.0,"2":0.0}'


def test_seconds_of_day(spark):
    df = spark.createDataFrame([("2024-02-07 11:59:44.123456",)], "tx_datetime string")
    from txsentry.operators.features import with_tx_time

    assert with_tx_time(df).first()["tx_time_seconds"] == 43184


def test_stream_equals_batch(spark):
    src = scratch_path(spark, "t-msgs")
    m = msg.messages_from_tx(catalog._tx(spark, SF_SMALL))
    files.write_parquet(m, src)
    model = ml.rule_model(60.0)
    batch = msg.encode_predictions(st.scored_rows(m, model))
    sink = scratch_path(spark, "t-sink")
    bad = st.bad_rows_parquet_sink(scratch_path(spark, "t-bad"))
    q = st.score_stream(st.file_message_source(spark, src, max_files=1), model, st.parquet_batch_sink(sink), bad, scratch_path(spark, "t-ck"), available_now=True)
    q.awaitTermination()
    streamed = spark.read.parquet(sink).drop("epoch")
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_stream_restart_does_not_repeat(spark):
    src = scratch_path(spark, "t-msgs2")
    m = msg.messages_from_tx(catalog._tx(spark, SF_SMALL))
    files.write_parquet(m, src)
    sink, ck = scratch_path(spark, "t-sink2"), scratch_path(spark, "t-ck2")
    model = ml.rule_model(60.0)
    for _ in range(2):
        bad = st.bad_rows_parquet_sink(scratch_path(spark, "t-bad2"))
        st.score_stream(st.file_message_source(spark, src), model, st.parquet_batch_sink(sink), bad, ck, available_now=True).awaitTermination()
    answered = msg.decode_messages(m).filter("is_valid").select("partition", "offset").distinct().count()
    assert spark.read.parquet(sink).count() == answered


def test_stream_survives_bad_input(spark, tmp_path):
    """A fitted tree on a session without map settings: a repeated id, a NULL customer, a
    message without a valid row and one that is no JSON. All rows come out somewhere."""
    old = spark.conf.get("spark.sql.mapKeyDedupPolicy", "EXCEPTION")
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "EXCEPTION")
    try:
        train = tx_rows(spark, [row(i, 100.0 if i % 2 else 1.0, fraud=i % 2, secs=i) for i in range(200)])
        model = ml.dt_pipeline(maxDepth=2).fit(train)
        values = [
            '[[1, "2024-02-07 11:59:44", 5, 9, 100.0], [2, "2024-02-07 11:59:45", 5, 9, 1.0], [1, "2024-02-07 11:59:46", 5, 9, 1.0]]',
            '[[3, "2024-02-07 11:59:44", null, 9, 100.0], [4, "2024-02-07 11:59:44", 1, 9, 100.0]]',
            '[[5, "never", 1, 9, 100.0], [6, "2024-02-07 11:59:44", 1, null, 100.0]]',
            "not json",
        ]
        src, sink, bad = (str(tmp_path / n) for n in ("src", "sink", "bad"))
        files.write_parquet(messages(spark, values), src)
        st.score_stream(st.file_message_source(spark, src), model, st.parquet_batch_sink(sink), st.bad_rows_parquet_sink(bad), str(tmp_path / "ck"), available_now=True).awaitTermination()
        got = {r["offset"]: (json.loads(r["value"]), r["n_rows"]) for r in spark.read.parquet(sink).collect()}
        assert got == {0: ({"1": 0.0, "2": 0.0}, 3), 1: ({"4": 1.0}, 1)}
        lost = sorted((r["offset"], r["pos"], r["transaction_id"]) for r in spark.read.parquet(bad).filter("pos is not null").collect())
        assert lost == [(1, 0, 3), (2, 0, 5), (2, 1, 6)]
        assert spark.read.parquet(bad).filter("pos is null").count() == 1
    finally:
        spark.conf.set("spark.sql.mapKeyDedupPolicy", old)


def test_stream_clean_keeps_late_rows(spark, tmp_path):
    """Rows far out of time order and copies in later micro-batches: the sink equals the
    batch job's result."""
    late = [row(1, 5.0, dt="2024-03-01 10:00:00.000000"), row(2, 6.0, dt="2024-01-01 10:00:00.000000"), row(3, 7.0, dt="2024-02-01 10:00:00.000000"), row(4, 8.0, dt="bad")]
    src = str(tmp_path / "src")
    for i, rows in enumerate([late[:1], late[1:2], late[2:], late]):
        tx_rows(spark, rows).coalesce(1).write.mode("append").parquet(src)
    sink = str(tmp_path / "sink")
    st.clean_stream_to(st.tx_file_source(spark, src, max_files=1), sink, 100.0, str(tmp_path / "ck"), available_now=True).awaitTermination()
    assert sorted(r["transaction_id"] for r in spark.read.parquet(sink).collect()) == [1, 2, 3, 4]


def test_framing_does_not_depend_on_the_layout(spark):
    rows = [row(7, 1.0)] * 20 + [row(7, 2.0)] * 3 + [row(None, 2.0)] * 4 + [row(i, float(i)) for i in range(100, 130)]
    a, b = (sorted(map(tuple, msg.messages_from_tx(tx_rows(spark, rows).repartition(n)).collect())) for n in (2, 7))
    assert a == b


def test_stream_clean_matches_batch(spark, tmp_path):
    rows = [row(i, float(i % 40), dt=f"2024-01-01 10:{i % 60:02d}:00.000000") for i in range(300)]
    rows += [rows[5], rows[6]]  # replayed copies
    df = tx_rows(spark, rows)
    src = str(tmp_path / "src")
    files.write_parquet(df, src)
    base = cl.drop_null_key(cl.filter_sentinel(cl.dedup_rows(df)))
    fence = cl.iqr_fences(base).first()["upper_fence"]
    out = str(tmp_path / "out")
    q = (
        st.clean_stream(st.tx_file_source(spark, src), fence)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", str(tmp_path / "ck"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == cl.clean(df).count() == 300
    assert got.agg(F.sum("transaction_id")).first()[0] == sum(range(300))


def test_framing_bounds_messages_with_repeated_ids(spark):
    from tests.conftest import row, tx_rows
    from txsentry.streaming.messages import decode_messages, messages_from_tx

    # one id holds a third of the rows, some ids are NULL; the rest are unique
    rows = [row(7, 1.0)] * 300 + [row(None, 2.0)] * 40 + [row(i, float(i)) for i in range(100, 700)]
    msgs = messages_from_tx(tx_rows(spark, rows))
    dec = decode_messages(msgs)
    sizes = [r["n"] for r in dec.groupBy("partition", "offset").count().withColumnRenamed("count", "n").collect()]
    assert max(sizes) <= 5
    assert dec.count() == len(rows)
    # unique ids keep the producer's framing: partition 0, offset = id div 5
    normal = dec.filter("transaction_id >= 100").select("partition", "offset", "transaction_id").collect()
    assert all(r["partition"] == 0 and r["offset"] == r["transaction_id"] // 5 for r in normal)
