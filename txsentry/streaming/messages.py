"""Message framing for the scoring stream.

Incoming value: a JSON array of 5-element arrays
``[transaction_id, "tx_datetime", customer_id, terminal_id, tx_amount]``.
Outgoing value: one JSON object per incoming message, ``{"<transaction_id>": prediction}``.

Both directions are column expressions (``from_json`` / ``to_json``), so they run
the same on a static table, inside ``foreachBatch`` and on a Kafka source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MSG_KEY = ["topic", "partition", "offset"]

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("value", T.StringType()),
    ]
)

ROW_FIELDS = ["transaction_id", "tx_datetime", "customer_id", "terminal_id", "tx_amount"]


def _json_num(c: str) -> F.Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("null"))


def _json_str(c: str) -> F.Column:
    """A JSON string literal (escaped) for a text column; ``null`` for NULL."""
    one = F.to_json(F.array(F.col(c)))  # ["..."]
    return one.substr(F.lit(2), F.length(one) - 2)


def messages_from_tx(tx: DataFrame, per_message: int = 5, topic: str = "data", key: str = "transaction_id") -> DataFrame:
    """Frame transactions into messages of ``per_message`` consecutive ids, as the
    producer does: offset = id div ``per_message``. The k-th row of an id travels in
    partition k - 1, so a message holds each id once and never more than ``per_message``
    rows, however often an id repeats. A row without an id is a message of its own, its
    offset a hash of its content (above all id offsets).

    One rule for all rows that depends on their content alone, so the framing is the same
    on every layout. Equal rows are counted before the shuffle, so copies of one row that
    make up a large share of the table cost one row per task.
    """
    known = F.col(key).isNotNull()
    distinct = tx.groupBy(*ROW_FIELDS).agg(F.count(F.lit(1)).alias("_n"))
    alone = F.shiftrightunsigned(F.xxhash64(*ROW_FIELDS), 2).bitwiseOR(F.lit(1 << 62))
    rows = distinct.withColumn("_m", F.when(known, F.floor(F.col(key) / F.lit(per_message))).otherwise(alone).cast("bigint"))
    rows = rows.withColumn("_same", F.when(known, F.col(key)).otherwise(alone))
    before = Window.partitionBy("_same", known).orderBy(*ROW_FIELDS).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_first", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    rows = rows.withColumn("_part", F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_n") - 1)))
    row_json = F.concat(
        F.lit("["),
        _json_num("transaction_id"),
        F.lit(","),
        _json_str("tx_datetime"),
        F.lit(","),
        _json_num("customer_id"),
        F.lit(","),
        _json_num("terminal_id"),
        F.lit(","),
        _json_num("tx_amount"),
        F.lit("]"),
    )
    framed = rows.select("_part", F.col("_m").alias("offset"), F.col(key).alias("_pos"), row_json.alias("_row"))
    grouped = framed.groupBy("_part", "offset").agg(F.sort_array(F.collect_list(F.struct("_pos", "_row"))).alias("_rows"))
    value = F.concat(F.lit("["), F.array_join(F.transform("_rows", lambda r: r["_row"]), ","), F.lit("]"))
    return grouped.select(F.lit(topic).alias("topic"), F.col("_part").cast("int").alias("partition"), "offset", value.alias("value"))


def decode_messages(msgs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per transaction in a message, with its position and a validity flag.

    Fields are read with ``get`` (NULL past the end of a short row) and ``try_cast``
    (NULL for a malformed value); an integer amount is accepted. A value that is
    not a JSON array of arrays gives one row with ``pos`` NULL. Rows with
    ``is_valid`` false are the side output.
    """
    keep = keep if keep is not None else [c for c in MSG_KEY if c in msgs.columns]
    arr = F.from_json(F.col("value"), "array<array<string>>")
    exploded = msgs.select(*keep, F.posexplode_outer(arr).alias("pos", "_r"))
    r = F.col("_r")
    out = exploded.select(
        *keep,
        "pos",
        F.get(r, 0).try_cast("bigint").alias("transaction_id"),
        F.get(r, 1).alias("tx_datetime"),
        F.get(r, 2).try_cast("bigint").alias("customer_id"),
        F.get(r, 3).try_cast("int").alias("terminal_id"),
        F.get(r, 4).try_cast("double").alias("tx_amount"),
        F.size(r).alias("_n"),
    )
    valid = (
        F.col("pos").isNotNull()
        & (F.col("_n") == 5)
        & F.col("transaction_id").isNotNull()
        & F.col("customer_id").isNotNull()
        & F.col("terminal_id").isNotNull()
        & F.col("tx_amount").isNotNull()
        & F.col("tx_datetime").try_cast("timestamp").isNotNull()
    )
    return out.withColumn("is_valid", F.coalesce(valid, F.lit(False))).drop("_n")


def encode_predictions(scored: DataFrame, key: list[str] | None = None, id_col: str = "transaction_id", pred: str = "prediction") -> DataFrame:
    """One outgoing message per incoming message: a JSON object from transaction id
    to prediction, in message order; a repeated id keeps its first place and its last value.
    Groups are messages, so each is bounded by the message size, and the work is linear in it:
    the last value of each (message, id) is found before a message's entries are collected.
    Rows are dealt once by message, which serves both groupings. A column ``model_version``
    (one value per message) is passed on."""
    key = key or MSG_KEY
    version = ["model_version"] if "model_version" in scored.columns else []
    rows = scored.select(*key, *version, "pos", F.col(id_col).cast("string").alias("k"), F.col(pred).cast("double").alias("v")).repartition(*key)
    one = [F.max(c).alias(c) for c in version]
    last = rows.groupBy(*key, "k").agg(F.min("pos").alias("first"), F.max_by("v", "pos").alias("v"), F.count(F.lit(1)).alias("n"), *one)
    g = last.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("first", "k", "v"))).alias("_e"), F.sum("n").cast("int").alias("n_rows"), *one)
    m = F.map_from_entries(F.transform("_e", lambda e: F.struct(e["k"], e["v"])))
    return g.select(*key, F.to_json(m).alias("value"), "n_rows", *version)
