"""Time features. One definition is shared by batch and stream scoring.

The session time zone must be UTC (see ``txsentry.session``); wall-clock parts
of a ``timestamp_ntz`` do not depend on it, those of a ``timestamp`` do.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def parse_ts(c: Column | str, fmt: str | None = None) -> Column:
    """String or timestamp to timestamp, by the pattern ``fmt`` if given; a malformed
    string becomes NULL instead of failing."""
    c = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else c.try_cast("timestamp")


def seconds_of_day(ts: Column | str) -> Column:
    """Whole seconds since midnight, from the wall-clock parts."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return (F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)).cast("int")


def days_since(ts: Column | str, origin: str = "2024-01-01") -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.datediff(ts.cast("date"), F.lit(origin).cast("date")).cast("int")


def time_parts_cols(ts: Column | str) -> dict[str, Column]:
    """Hour, minute of hour, minutes since midnight and seconds since midnight."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return {
        "hour_of_day": F.hour(ts).cast("int"),
        "minute_of_hour": F.minute(ts).cast("int"),
        "minutes_from_start": (F.hour(ts) * 60 + F.minute(ts)).cast("double"),
        "tx_time_seconds": seconds_of_day(ts),
    }
