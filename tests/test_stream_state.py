"""The streaming clean's keyed state: copies across batches, restarts, late rows, bounds."""

from pyspark.sql import functions as F

from tests.conftest import row, tx_rows
from txsentry.streaming import score as st


def feed(spark, src, rows):
    tx_rows(spark, rows).coalesce(1).write.mode("append").parquet(src)


def run(spark, tmp_path, **kw):
    q = st.clean_stream_to(st.tx_file_source(spark, str(tmp_path / "src"), max_files=1), str(tmp_path / "sink"), 100.0, str(tmp_path / "ck"), available_now=True, **kw)
    q.awaitTermination()
    assert q.exception() is None


def ids(spark, path):
    return sorted(r["transaction_id"] for r in spark.read.parquet(str(path)).collect())


def day(n):
    return f"2024-01-{n:02d} 10:00:00.000000"


def test_copies_restart_late_rows_and_bounded_state(spark, tmp_path):
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    src = str(tmp_path / "src")
    feed(spark, src, [row(i, 5.0, dt=day(1 + i % 3)) for i in range(30)])
    feed(spark, src, [row(i, 5.0, dt=day(1 + i % 3)) for i in range(20, 40)] + [row(3, 6.0, dt=day(1)), row(2**60 + 1, 7.0, customer=None), row(41, 101.0), row(42, 5.0, dt="bad"), row(42, 5.0, dt="bad")])
    run(spark, tmp_path, horizon_days=5, buckets=2)
    first = [*range(40), 3, 42]
    assert ids(spark, tmp_path / "sink") == sorted(first)
    # a restart: copies of both files, a later day, and a row that is beyond the horizon after it
    feed(spark, src, [row(i, 5.0, dt=day(1 + i % 3)) for i in range(40)] + [row(42, 5.0, dt="bad")] + [row(100 + i, 5.0, dt=day(20)) for i in range(8)])
    run(spark, tmp_path, horizon_days=5, buckets=2)
    assert ids(spark, tmp_path / "sink") == sorted([*first, *range(100, 108)])
    feed(spark, src, [row(0, 5.0, dt=day(1)), row(200, 5.0, dt=day(2)), row(201, 5.0, dt=day(16)), row(100, 5.0, dt=day(20))])
    run(spark, tmp_path, horizon_days=5, buckets=2)
    assert ids(spark, tmp_path / "sink") == sorted([*first, *range(100, 108), 201])
    assert ids(spark, tmp_path / "sink-late") == [0, 200]
    # only days within the horizon (and rows without a time) are left in the state
    state = spark.read.format("statestore").option("stateVarName", "days").load(str(tmp_path / "ck"))
    days = {r["k"] for r in state.select(F.col("user_map_key.day").alias("k")).collect()}
    newest = (2024 - 1970) * 365 + 13 + 19
    assert days == {-1, newest, newest - 4}
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == old


def test_every_column_tells_rows_apart(spark, tmp_path):
    base = (1, day(1), 1, 1, 5.0, 1, 0, 0, None)
    rows = [base, (2, *base[1:]), (1, day(2), *base[2:]), (1, day(1), 2, *base[3:]), (1, day(1), 1, 2, *base[4:]), (*base[:4], 5.000000000000001, *base[5:]), (*base[:5], None, 0, 0, None), (*base[:6], 7, 0, None), (*base[:7], None, None), (*base[:8], 0)]
    src = str(tmp_path / "src")
    feed(spark, src, rows)
    feed(spark, src, rows[::-1])
    run(spark, tmp_path)
    got = spark.read.parquet(str(tmp_path / "sink")).drop("epoch").collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, rows))


def test_a_day_is_read_and_written_once_a_micro_batch():
    """However many chunks a micro-batch comes in; the state grows with its rows, the work must
    not grow with chunks x state."""
    import pandas as pd

    from txsentry.streaming.seen import _processor

    calls, days, value = [], {}, {}

    class Days:
        def getValue(self, key):
            calls.append(("get", key[0]))
            return days.get(key[0])

        def updateValue(self, key, v):
            calls.append(("put", key[0]))
            days[key[0]] = v

        def keys(self):
            return [(k,) for k in days]

        def removeKey(self, key):
            del days[key[0]]

    class Newest:
        def get(self):
            return value.get("v")

        def update(self, v):
            value["v"] = v

    class Handle:
        def getMapState(self, *a):
            return Days()

        def getValueState(self, *a):
            return Newest()

    def chunks(lo):
        for c in range(5):
            n = [(lo + c * 10 + i) % 40 for i in range(10)]
            yield pd.DataFrame({"day": [1 + i % 2 for i in n], "digest": [i.to_bytes(16, "big") for i in n], "row": [str(i) for i in n]})

    seen = _processor(5)
    seen.init(Handle())
    first = pd.concat(seen.handleInputRows((0,), chunks(0), None))
    assert sorted(map(int, first["row"])) == list(range(40)) and not first["is_late"].any()
    assert sorted(calls) == [("get", 1), ("get", 2), ("put", 1), ("put", 2)]
    calls.clear()
    assert sum(len(f) for f in seen.handleInputRows((0,), chunks(0), None)) == 0
    assert sorted(calls) == [("get", 1), ("get", 2)]
