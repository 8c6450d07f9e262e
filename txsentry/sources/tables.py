"""Input tables.

``events`` stands in for the raw transaction table:
event_id -> transaction_id, ts -> tx_datetime (text, as in the raw CSV),
user_id -> customer_id, props.k -> terminal_id, value -> tx_amount,
seconds of day -> tx_time_seconds, days since 2024-01-01 -> tx_time_days,
event_type = 'error' -> tx_fraud. There is no fraud scenario column, so
tx_fraud_scenario is NULL.

The driver's events are clean, so the mapping makes them as dirty as the raw feed, by
rules on the id that the oracle states as well: every tenth row comes twice, some keys
are the sentinel or NULL, some amounts are NULL, and rows lie in three 31-day spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txsentry.functions.timefeat import TS_FORMAT, days_since, seconds_of_day

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# The raw transaction layout (all columns nullable).
TX_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.LongType(), True),
        T.StructField("tx_datetime", T.StringType(), True),
        T.StructField("customer_id", T.LongType(), True),
        T.StructField("terminal_id", T.IntegerType(), True),
        T.StructField("tx_amount", T.DoubleType(), True),
        T.StructField("tx_time_seconds", T.IntegerType(), True),
        T.StructField("tx_time_days", T.IntegerType(), True),
        T.StructField("tx_fraud", T.IntegerType(), True),
        T.StructField("tx_fraud_scenario", T.IntegerType(), True),
    ]
)
TX_COLUMNS = [f.name for f in TX_SCHEMA.fields]

FEATURES = ["customer_id", "terminal_id", "tx_amount", "tx_time_seconds"]
LABEL = "tx_fraud"
ID = "transaction_id"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Every how many ids a row is repeated or loses a value.
REPEAT_EVERY, SENTINEL_EVERY, NULL_CUSTOMER_EVERY, NULL_TERMINAL_EVERY, NULL_AMOUNT_EVERY = 10, 37, 43, 41, 53
SPANS, SPAN_DAYS = 3, 31


def tx_from_events(events: DataFrame) -> DataFrame:
    key = F.col("event_id").cast("bigint")

    def every(n: int) -> Column:
        return key % n == 0

    copies = F.when(every(REPEAT_EVERY), F.sequence(F.lit(1), F.lit(2))).otherwise(F.sequence(F.lit(1), F.lit(1)))
    ts = F.timestamp_add("DAY", (key % SPANS) * SPAN_DAYS, F.col("ts"))
    rows = events.select("event_id", ts.alias("ts"), "user_id", "props", "value", "event_type", F.explode(copies).alias("_copy"))
    ts = F.col("ts")
    return rows.select(
        key.alias("transaction_id"),
        F.date_format(ts, TS_FORMAT).alias("tx_datetime"),
        F.when(every(SENTINEL_EVERY), F.lit(-999999)).when(~every(NULL_CUSTOMER_EVERY), F.col("user_id")).cast("bigint").alias("customer_id"),
        F.when(~every(NULL_TERMINAL_EVERY), F.get_json_object("props", "$.k").try_cast("int")).alias("terminal_id"),
        F.when(~every(NULL_AMOUNT_EVERY), F.col("value")).cast("double").alias("tx_amount"),
        seconds_of_day(ts).alias("tx_time_seconds"),
        days_since(ts).alias("tx_time_days"),
        (F.col("event_type") == F.lit("error")).cast("int").alias("tx_fraud"),
        F.lit(None).cast("int").alias("tx_fraud_scenario"),
    )


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw transaction table over ``events``."""
    return tx_from_events(table(spark, sf_dir, "events"))


# The same mapping for DuckDB (views of the driver's tables).
TX_SQL = """(
  SELECT CAST(event_id AS BIGINT) AS transaction_id,
         strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS tx_datetime,
         CAST(CASE WHEN event_id % 37 = 0 THEN -999999 WHEN event_id % 43 <> 0 THEN user_id END AS BIGINT) AS customer_id,
         CASE WHEN event_id % 41 <> 0 THEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) END AS terminal_id,
         CAST(CASE WHEN event_id % 53 <> 0 THEN value END AS DOUBLE) AS tx_amount,
         CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS INTEGER) AS tx_time_seconds,
         CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS tx_time_days,
         CAST(event_type = 'error' AS INTEGER) AS tx_fraud,
         CAST(NULL AS INTEGER) AS tx_fraud_scenario
  FROM (SELECT * REPLACE (ts + to_days(CAST(31 * (event_id % 3) AS INTEGER)) AS ts),
               unnest(range(0, CASE WHEN event_id % 10 = 0 THEN 2 ELSE 1 END)) AS _copy
        FROM events)
)"""
