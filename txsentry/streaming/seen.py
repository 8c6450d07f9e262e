"""Keyed state for the streaming clean: which rows have been seen, for how long.

Rows are dealt to ``buckets`` by a hash of all their columns, so copies meet in one bucket. A
bucket holds, per event day, the 16-byte digests of its rows (one state entry a day), and
the newest day it has seen. A day that lies more than ``horizon_days`` behind it is
forgotten; a row of such a day cannot be told from its copies any more and is marked as
late. So the state is bounded by the rows of ``horizon_days``, a micro-batch touches only the
days that it has rows of, each read and written once, and what becomes of a row depends on the rows of its bucket alone.

Rows without a readable time have no day; their digests are kept under a day of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NO_DAY = -1
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
OUT = "row string, is_late boolean"


def _processor(horizon_days: int):
    """The processor, made inside a function so that it is sent to the workers by value."""
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor

    width, no_day = 16, NO_DAY

    class Seen(StatefulProcessor):
        def init(self, handle) -> None:
            self.days = handle.getMapState("days", "day int", "digests binary")
            self.newest = handle.getValueState("newest", "day int")

        def handleInputRows(self, key, rows, timerValues):
            held = self.newest.get()
            newest = before = held[0] if held else None
            olds, known, fresh = {}, {}, {}  # by day: read once a micro-batch, written once at its end
            for chunk in rows:
                out, late = [], []
                for day, digest, row in zip(chunk["day"].tolist(), chunk["digest"], chunk["row"]):
                    if day != no_day and before is not None and day < before - horizon_days:
                        out.append(row)
                        late.append(True)
                        continue
                    if day not in known:
                        entry = self.days.getValue((day,))
                        old = olds[day] = bytes(entry[0]) if entry else b""
                        known[day] = {old[i : i + width] for i in range(0, len(old), width)}
                        fresh[day] = []
                    digest = bytes(digest)
                    if digest not in known[day]:
                        known[day].add(digest)
                        fresh[day].append(digest)
                        out.append(row)
                        late.append(False)
                yield pd.DataFrame({"row": pd.Series(out, dtype=object), "is_late": pd.Series(late, dtype=bool)})
            for day, more in fresh.items():
                if more:
                    self.days.updateValue((day,), (olds[day] + b"".join(more),))
                if day != no_day:
                    newest = day if newest is None else max(newest, day)
            if newest is not None and newest != before:
                self.newest.update((newest,))
                for day in [k[0] for k in self.days.keys()]:
                    if day != no_day and day < newest - horizon_days:
                        self.days.removeKey((day,))

        def close(self) -> None:
            pass

    return Seen()


def first_rows(rows: DataFrame, schema: T.StructType, time_col: str, horizon_days: int, buckets: int) -> DataFrame:
    """``rows`` of a stream without copies, and ``is_late``. A row travels as JSON text, which
    keeps NULLs and whole numbers as they are."""
    names = schema.names
    day = F.coalesce(F.unix_date(F.to_date(F.col(time_col).try_cast("timestamp"))), F.lit(NO_DAY))
    packed = F.to_json(F.struct(*names))
    keyed = rows.select(F.pmod(F.xxhash64(*names), F.lit(buckets)).cast("int").alias("bucket"), day.alias("day"), packed.alias("row"))
    keyed = keyed.withColumn("digest", F.unhex(F.md5("row")))
    out = keyed.groupBy("bucket").transformWithStateInPandas(_processor(horizon_days), outputStructType=OUT, outputMode="Append", timeMode="None")
    return out.select(F.from_json("row", schema).alias("r"), "is_late").select("r.*", "is_late")


def start_with_rocksdb(spark: SparkSession, start):
    """Run ``start`` (which starts a query) with the state store that keyed state needs; the
    query keeps the setting, the session gets its own back."""
    old = spark.conf.get(STORE_CONF, None)
    spark.conf.set(STORE_CONF, ROCKSDB)
    try:
        return start()
    finally:
        if old is None:
            spark.conf.unset(STORE_CONF)
        else:
            spark.conf.set(STORE_CONF, old)
