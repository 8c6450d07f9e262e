"""The outbox, long messages, and the cleaning run with stored sketches."""

import json
import math
from collections import Counter

import pytest

from tests.conftest import row, tx_rows
from txsentry.operators import ml
from txsentry.plans import jobs
from txsentry.sources import files
from txsentry.streaming import messages as msg
from txsentry.streaming import score as st


class Receiver:
    """Holds what was sent; fails after so many slices."""

    def __init__(self, fail_after=None):
        self.got, self.calls, self.fail_after = Counter(), 0, fail_after

    def __call__(self, answers):
        if self.calls == self.fail_after:
            raise ConnectionError("receiver is gone")
        self.calls += 1
        self.got.update((r["partition"], r["offset"], r["value"]) for r in answers.collect())


def test_each_message_is_answered_once_after_a_failure(spark, tmp_path):
    src, box, ck = (str(tmp_path / n) for n in ("src", "box", "ck"))
    values = [f'[[{i}, "2024-02-07 11:59:44", 5, 9, {100.0 * (i % 2)}]]' for i in range(60)]
    frame = spark.createDataFrame([("data", 0, i, v) for i, v in enumerate(values)], msg.MESSAGE_SCHEMA)
    files.write_parquet(frame, src)

    def start(receiver, threshold):
        bad = st.bad_rows_parquet_sink(str(tmp_path / "bad"))
        return st.score_stream(st.file_message_source(spark, src), ml.rule_model(threshold), st.outbox_sink(box, receiver), bad, ck, available_now=True)

    first = Receiver(fail_after=3)
    with pytest.raises(Exception, match="receiver is gone"):
        start(first, 60.0).awaitTermination()
    assert 0 < len(first.got) < 60
    # the model has changed meanwhile: the replayed epoch still gives the answers it wrote
    second = Receiver()
    start(second, 1e300).awaitTermination()
    assert first.got + second.got == Counter({(0, i, json.dumps({str(i): float(i % 2)}, separators=(",", ":"))): 1 for i in range(60)})
    again = Receiver()
    start(again, 60.0).awaitTermination()
    assert not again.got


def test_long_message_is_linear(spark):
    """100,000 entries in one message, every id twice, in one task."""
    n = 50_000
    entries = [[i, "2024-02-07 11:59:44", 5, 9, float(i % 7)] for i in range(n)] + [[i, "2024-02-07 11:59:45", 5, 9, 100.0 * (i % 2)] for i in range(n)]
    frame = spark.createDataFrame([("data", 0, 1, json.dumps(entries))], msg.MESSAGE_SCHEMA)
    out = msg.encode_predictions(ml.rule_model(60.0).transform(msg.decode_messages(frame).filter("is_valid"))).collect()
    assert len(out) == 1 and out[0]["n_rows"] == 2 * n
    got = json.loads(out[0]["value"])
    assert list(got) == [str(i) for i in range(n)] and all(v == i % 2 for i, v in enumerate(got.values()))


def test_clean_run_job(spark, tmp_path):
    dst, held = str(tmp_path / "dst"), str(tmp_path / "sketches")
    parts = [[row(i, float(i % 100), days=i % 4) for i in range(400)], [row(1000 + i, 5000.0 if i % 10 == 0 else 50.0, days=9) for i in range(50)] + [row(2000, None, days=9), row(2001, 1.0, customer=-999999)]]
    for k, rows in enumerate(parts):
        files.write_parquet(tx_rows(spark, [*rows, rows[0]]), str(tmp_path / f"src{k}"))
    for k in (0, 1, 1, 0):
        out = jobs.clean_run_job(spark, str(tmp_path / f"src{k}"), dst, held, f"r{k}", fmt="parquet")
        if k:
            values = sorted(r[4] for p in parts for r in p if r[4] is not None and r[2] != -999999)
            q1, q3 = (values[math.ceil(p * len(values)) - 1] for p in (0.25, 0.75))
            kept = sorted(r["tx_amount"] for r in out.collect())
            assert kept == sorted(r[4] for r in parts[1] if r[4] is not None and r[2] != -999999 and r[4] <= q3 + 1.5 * (q3 - q1) + 5) and len(kept) == 45
        else:
            assert out.count() == 400
    new = jobs.clean_run_job(spark, str(tmp_path / "src1"), dst, held, "r1", fmt="parquet", keep_days=1)
    assert new.count() == 45  # quartiles of the newest day alone: all at 50
    assert spark.read.parquet(dst).count() == 445
