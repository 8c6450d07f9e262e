"""Rows without an id have one key in every query and job."""

from pyspark.sql import functions as F

from tests.conftest import row, tx_rows
from txsentry.operators import clean as cl
from txsentry.operators import sampling
from txsentry.plans import catalog, jobs
from txsentry.session import scratch_path
from txsentry.sources import files
from txsentry.sources.tables import ID


def test_one_key_for_rows_without_an_id(spark, monkeypatch):
    rows = tx_rows(spark, [row(None if i % 2 else i, float(i % 50), customer=i, secs=i) for i in range(1000)] + [row(None, 7.0, customer=5000), row(None, None, customer=5001)])
    monkeypatch.setattr(catalog, "_tx", lambda spark, sf: rows)
    kept = {c: catalog._filled(spark, "", [ID, "customer_id", *c]) for c in ((), ("tx_amount",), ("tx_fraud", "terminal_id"))}
    keys = [{r["customer_id"]: r[ID] for r in df.select("customer_id", ID).collect()} for df in kept.values()]
    assert keys[0] == keys[1] == keys[2] and len(set(keys[0].values())) == 1001
    assert all((k == c) if c % 2 == 0 and c < 1000 else k < 0 for c, k in keys[0].items())
    # the training job reads the clean table and gives the same keys
    path = scratch_path(spark, "t-keys")
    files.write_parquet(cl.clean(rows), path)
    assert {r["customer_id"]: r[ID] for r in jobs.prepared(files.read_parquet(spark, path)).collect()} == keys[0]
    alone = catalog._filled(spark, "", [ID]).filter(F.col(ID) < 0)
    parts = [p.count() for p in sampling.split_hash(alone, [0.9, 0.1])]
    assert sum(parts) == 501 and 20 < parts[1] < 90
