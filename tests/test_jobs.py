"""The user-level jobs end to end: raw CSV -> clean -> train -> A/B verdict."""

import random
from pathlib import Path

from tests.conftest import row, tx_rows
from txsentry.operators import ml
from txsentry.plans import jobs
from txsentry.session import scratch_dir
from txsentry.sources import files


def raw_rows(n=1500, seed=9):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        y = int(rnd.random() < 0.25)
        amount = round(rnd.uniform(1, 50) + (40 if y else 0), 2)
        customer = -999999 if i % 100 == 0 else rnd.randint(0, 300)
        terminal = None if i % 150 == 1 else rnd.randint(0, 50)
        secs = rnd.randint(0, 86399)
        dt = f"2024-01-0{1 + i % 9} {secs // 3600:02d}:{secs % 3600 // 60:02d}:{secs % 60:02d}.000000"
        rows.append(row(i, amount, customer=customer, terminal=terminal, fraud=y, dt=dt, secs=secs, days=i % 9))
    rows.append((99999, "x", 1, 1, 10000.0, 1, 1, 0, None))  # far above any fence
    return rows + rows[:40]  # repeated rows


def expected_clean(rows):
    import math

    base = {r for r in rows if r[2] is not None and r[2] != -999999 and r[3] is not None}
    amounts = sorted(r[4] for r in base if r[4] is not None)
    q1 = amounts[math.ceil(0.25 * len(amounts)) - 1]
    q3 = amounts[math.ceil(0.75 * len(amounts)) - 1]
    fence = q3 + 1.5 * (q3 - q1)
    return {r for r in base if r[4] is not None and r[4] <= fence}


def test_clean_train_validate(spark, tmp_path):
    rows = raw_rows()
    src = str(tmp_path / "raw")
    files.write_csv(tx_rows(spark, rows), src)
    dst = str(tmp_path / "clean")
    scratch = Path(scratch_dir(spark).removeprefix("file:"))
    stages_before = set(scratch.glob("clean-stage-*"))
    clean = jobs.clean_job(spark, src, dst, raw_copy=str(tmp_path / "raw_copy"))
    want = expected_clean(rows)
    got = {tuple(r) for r in clean.collect()}
    assert got == want
    assert set(scratch.glob("clean-stage-*")) == stages_before  # the job removed its staged copy

    model, metrics = jobs.train_job(
        spark, dst, str(tmp_path / "model"), params={"numTrees": 10, "maxDepth": 4}, run_log=str(tmp_path / "runs")
    )
    base_rate = sum(r[7] for r in want) / len(want)
    assert metrics["areaUnderPR"] > base_rate + 0.2
    assert spark.read.parquet(str(tmp_path / "runs")).filter("kind = 'metric'").count() == 2
    keys = {r["key"] for r in spark.read.parquet(str(tmp_path / "runs")).collect()}
    assert {"features", "split", "numTrees", "areaUnderPR", "f1"} <= keys

    # B flags nothing: every F1 of B is undefined, counted, and the verdict cannot be decided
    never = ml.rule_model(1e12)
    v = jobs.ab_job(spark, dst, str(tmp_path / "model"), never, reps=20).first()
    assert v["n_undefined_b"] == 20 and v["mean_b"] is None
    assert v["mean_a"] > 0 and v["verdict"] == "undefined"
    assert v["p_value"] is None and v["same_distribution"] is None



def test_rows_without_a_key_are_split_alike(spark):
    """Training and validation prepare rows the same way, so a row without an id lies in
    the same part for both, and such rows spread over the parts."""
    df = tx_rows(spark, [row(None, float(i)) for i in range(400)])
    train, test = jobs.train_test(jobs.prepared(df))
    n = test.count()
    assert train.count() + n == 400 and 10 < n < 80
    assert {r.transaction_id for r in test.collect()} == {r.transaction_id for r in jobs.train_test(jobs.prepared(df.repartition(5)))[1].collect()}


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    import types

    import pytest

    from txsentry import session

    class Conf:
        def get(self, key, default=None):
            return default

    sc = types.SimpleNamespace(getConf=Conf, applicationId="app-x", master="spark://h:7077", getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_dir(types.SimpleNamespace(sparkContext=sc, conf=Conf()))
