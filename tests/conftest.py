import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from txsentry.session import local_session  # noqa: E402
from txsentry.sources.tables import TX_SCHEMA  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="txsentry-tests")
    yield s


def tx_rows(spark, rows):
    """Rows as tuples in TX_SCHEMA order (missing trailing fields are NULL)."""
    n = len(TX_SCHEMA.fields)
    full = [tuple(r) + (None,) * (n - len(r)) for r in rows]
    return spark.createDataFrame(full, TX_SCHEMA)


def row(tid, amount, customer=1, terminal=1, fraud=0, dt="2024-01-01 10:00:00.000000", secs=36000, days=0, scen=None):
    return (tid, dt, customer, terminal, amount, secs, days, fraud, scen)
