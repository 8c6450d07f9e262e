import math
import random

from pyspark.sql import functions as F

from tests.conftest import row, tx_rows
from txsentry.operators import clean as cl
from txsentry.sources import files


def amounts(df):
    return sorted(r["tx_amount"] for r in df.collect())


def test_dedup_full_row(spark):
    df = tx_rows(spark, [row(1, 10.0), row(1, 10.0), row(1, 11.0)])
    out = cl.dedup_rows(df)
    assert out.count() == 2
    assert amounts(out) == [10.0, 11.0]


def test_sentinel_and_null_keys(spark):
    df = tx_rows(
        spark,
        [
            row(1, 1.0, customer=None),
            row(2, 1.0, customer=-999999),
            row(3, 1.0, customer=-9999999),
            row(4, 1.0, terminal=None),
            row(5, 1.0),
        ],
    )
    ids = sorted(r[0] for r in cl.filter_sentinel(df).select("transaction_id").collect())
    assert ids == [3, 4, 5]  # NULL and -999999 dropped, -9999999 kept
    ids = sorted(r[0] for r in cl.drop_null_key(df).select("transaction_id").collect())
    assert ids == [1, 2, 3, 5]


def test_null_key_filter_reaches_scan(spark, tmp_path):
    p = str(tmp_path / "t")
    files.write_parquet(tx_rows(spark, [row(1, 1.0), row(2, 1.0, terminal=None)]), p)
    out = cl.drop_null_key(files.read_parquet(spark, p))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(terminal_id)" in plan


def test_fence_upper_only_and_null_amount(spark):
    rows = [row(i, float(i)) for i in range(1, 10)] + [row(10, 100.0), row(11, None)]
    out = cl.clean(tx_rows(spark, rows))
    # q1 = 3, q3 = 8 (smallest value reaching the share), fence 15.5: 100 and NULL go
    assert amounts(out) == [float(i) for i in range(1, 10)]
    f = cl.iqr_fences(cl.dedup_rows(tx_rows(spark, rows))).first()
    assert (f["q1"], f["q3"], f["upper_fence"]) == (3.0, 8.0, 15.5)


def test_row_equal_to_fence_is_kept(spark):
    rows = [row(i, float(i)) for i in range(1, 10)] + [row(10, 15.5)]
    out = cl.clean(tx_rows(spark, rows))
    assert 15.5 in amounts(out)


def brute_disc(values, p):
    s = sorted(values)
    k = max(1, math.ceil(p * len(s)))
    return s[k - 1]


def test_exact_quantiles_match_brute_force(spark):
    rnd = random.Random(7)
    vals = [float(rnd.randint(0, 60)) for _ in range(700)] + [5.0] * 300  # one hot value
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(5)
    probs = [0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    for parts in (1, 3, 16):
        got = cl.quantiles(df, "x", probs, partitions=parts).first()
        assert [got[f"q{i}"] for i in range(len(probs))] == [brute_disc(vals, p) for p in probs]


def test_approx_quantiles_within_rank_error(spark):
    vals = [float(i) for i in range(1000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = cl.quantiles(df, "x", [0.25, 0.75], method="approx", rel_error=0.05).first()
    assert abs(got["q0"] - 250) <= 50 and abs(got["q1"] - 750) <= 50


def test_clean_is_idempotent_for_a_fixed_fence(spark):
    rnd = random.Random(3)
    rows = [row(i, round(rnd.expovariate(0.05), 2)) for i in range(500)]
    df = tx_rows(spark, rows)
    fence = cl.iqr_fences(cl.dedup_rows(df)).first()["upper_fence"]
    once = cl.apply_upper_fence(df, "tx_amount", F.lit(fence))
    twice = cl.apply_upper_fence(once, "tx_amount", F.lit(fence))
    assert once.count() == twice.count()


def test_clean_plan_is_one_lazy_plan(spark):
    rows = [row(i, float(i % 17)) for i in range(200)]
    out = cl.clean(tx_rows(spark, rows))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in plan  # fence is a scalar subquery, not a driver round trip


def test_csv_permissive(spark, tmp_path):
    p = tmp_path / "raw"
    p.mkdir()
    (p / "part.csv").write_text(
        "transaction_id,tx_datetime,customer_id,terminal_id,tx_amount,tx_time_seconds,tx_time_days,tx_fraud,tx_fraud_scenario\n"
        "1,2024-01-01 00:00:01,5,9,zz,1,0,0,0\n"
        ",2024-01-01 00:00:02,5,9,10.5,2,0,1,1\n"
    )
    got = sorted(files.read_csv(spark, str(p)).collect(), key=lambda r: r["tx_time_seconds"])
    assert got[0]["transaction_id"] == 1 and got[0]["tx_amount"] is None
    assert got[1]["transaction_id"] is None and got[1]["tx_amount"] == 10.5


def test_fill_zero_numeric_only(spark):
    df = tx_rows(spark, [(1, None, None, 3, None)])
    r = cl.fill_zero(df).first()
    assert r["tx_datetime"] is None and r["customer_id"] == 0 and r["tx_amount"] == 0.0 and r["tx_fraud_scenario"] == 0
