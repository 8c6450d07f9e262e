"""Feature columns. Batch training and stream scoring call the same functions,
so a model always sees the column names it was trained on."""

from __future__ import annotations

from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txsentry.functions.timefeat import parse_ts, seconds_of_day, time_parts_cols
from txsentry.sources.tables import FEATURES, LABEL


def project_features(df: DataFrame, features: list[str] | None = None, label: str = LABEL, keep: list[str] | None = None) -> DataFrame:
    """The training projection: features and label (plus any ``keep`` columns)."""
    return df.select(*(keep or []), *(features or FEATURES), label)


def with_tx_time(df: DataFrame, ts_col: str = "tx_datetime", out: str = "tx_time_seconds") -> DataFrame:
    """Parse the transaction time (NULL when malformed) and add whole seconds since
    midnight under the name the models are trained on."""
    return df.withColumn(out, seconds_of_day(parse_ts(ts_col)))


def with_time_parts(df: DataFrame, ts_col: str = "tx_datetime", fmt: str | None = None) -> DataFrame:
    """Hour of day, minute of hour, minutes since midnight, seconds since midnight."""
    return df.withColumns(time_parts_cols(parse_ts(ts_col, fmt)))


def assembler(features: list[str] | None = None, out: str = "features", handle_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features or FEATURES), outputCol=out, handleInvalid=handle_invalid)


def scaler(inp: str = "features", out: str = "scaledFeatures") -> MinMaxScaler:
    return MinMaxScaler(inputCol=inp, outputCol=out)


def vector_columns(df: DataFrame, vec: str, names: list[str], prefix: str) -> DataFrame:
    """Spread a vector column into one double column per feature."""
    arr = vector_to_array(F.col(vec))
    return df.select("*", *[arr[i].alias(f"{prefix}{n}") for i, n in enumerate(names)]).drop(vec)
