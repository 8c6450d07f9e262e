"""Quartiles by bracketed selection and by stored sketches."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tests.test_scale import _plan
from txsentry.operators import clean as cl, selection

PROBS = [0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0]


def want(values, probs=PROBS):
    """The smallest value whose cumulative share reaches p; NaN counts as the greatest."""
    v = sorted((x for x in values if x is not None), key=lambda x: (x != x, x))
    return [v[min(len(v), max(1, math.ceil(p * len(v)))) - 1] for p in probs] if v else [None] * len(probs)


def same(a, b):
    return all(x == y or (x != x and y != y) for x, y in zip(a, b)) and len(a) == len(b)


CASES = {
    "spread": [random.Random(1).gauss(0, 1) for _ in range(6000)],
    "one value fills a bracket": [float(i) for i in range(1000)] + [500.5] * 4000 + [float(i) for i in range(1000, 2000)],
    "edge of a heavy value": [1.0] * 2499 + [2.0] * 2501 + [float(i) for i in range(3, 5003)],
    "all equal": [7.0] * 5000,
    "two values": [1.0] * 2500 + [2.0] * 2500,
    "nulls and NaN": [None] * 500 + [float("nan")] * 3000 + [float(i) for i in range(1500)],
    "only NaN": [float("nan")] * 3000,
    "infinite": [float("inf")] * 2000 + [-float("inf")] * 2000 + [0.0, -0.0, 1.0] * 700,
    "one": [3.0],
    "none": [None, None],
}


@pytest.mark.parametrize("name", CASES)
def test_any_shape_any_limit(spark, name):
    values = CASES[name]
    df = spark.createDataFrame([(x,) for x in values], "v double").repartition(3)
    for limit in (1, 50, 1 << 16):
        assert same(selection.select_ranks(df, "v", PROBS, limit), want(values)), limit


def test_whole_numbers_beyond_doubles(spark):
    base = 1 << 60
    values = [base + random.Random(2).randrange(10**6) for _ in range(3000)] + [base + 5] * 2000
    df = spark.createDataFrame([(x,) for x in values], "v long")
    assert selection.select_ranks(df, "v", PROBS, 10) == want(values)
    assert cl.quantiles(df, "v", [0.5]).schema["q0"].dataType == df.schema["v"].dataType


def test_empty_and_other_types(spark):
    assert selection.select_ranks(spark.createDataFrame([], "v double"), "v", [0.5]) == [None]
    q = cl.quantiles(spark.createDataFrame([], "v double"), "v", [0.5])
    assert [tuple(r) for r in q.collect()] == [(None,)]
    dec = spark.range(101).select(F.col("id").cast("decimal(10,2)").alias("v"))
    assert cl.quantiles(dec, "v", [0.25]).first()["q0"] == 25
    with pytest.raises(TypeError):
        selection.select_ranks(dec, "v", [0.5])
    assert cl.quantiles(spark.range(101).toDF("v"), "v", [0.25], method="ranks").first()["q0"] == 25


def test_no_value_is_shuffled(spark, tmp_path):
    """Neither the passes nor the result have an exchange of more than one row a task."""
    p = str(tmp_path / "t")
    spark.range(300_000).select(F.rand(1).alias("v")).write.parquet(p)
    df = spark.read.parquet(p)
    plan = _plan(cl.iqr_fences(df, "v", staged=True))
    assert "Exchange" not in plan and "Sort" not in plan
    assert selection.select_ranks(df, "v", [0.25], 1000) == selection.select_ranks(df, "v", [0.25])
