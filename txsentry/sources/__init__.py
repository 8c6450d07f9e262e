from txsentry.sources.tables import (
    FEATURES,
    ID,
    LABEL,
    TABLES,
    TX_COLUMNS,
    TX_SCHEMA,
    TX_SQL,
    table,
    tx,
    tx_from_events,
)
from txsentry.sources.files import materialize, read_csv, read_parquet, write_csv, write_parquet

__all__ = [
    "FEATURES",
    "ID",
    "LABEL",
    "TABLES",
    "TX_COLUMNS",
    "TX_SCHEMA",
    "TX_SQL",
    "table",
    "tx",
    "tx_from_events",
    "materialize",
    "read_csv",
    "read_parquet",
    "write_csv",
    "write_parquet",
]
