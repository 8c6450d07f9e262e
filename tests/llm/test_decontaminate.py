import hashlib
import re

import duckdb
import pytest

from tests.llm.conftest import EDGE, SF, docs
from txsentry.llm import decontaminate as dc, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(rows, items, window=13):
    grams = {}
    for k, t in items:
        ws = words(t)
        for i in range(max(1, len(ws) - window + 1) if ws else 0):
            grams.setdefault(tuple(ws[i : i + window]), set()).add(k)
    out = {}
    for d, t in rows:
        ws, hit, found = words(t), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(ws) - n + 1):
                if (g := tuple(ws[i : i + n])) in grams:
                    hit.update(range(i, i + n))
                    found |= grams[g]
        names = sorted(str(k) for k in found if k is not None)
        out[d] = (len(ws), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(ws))
    return out


def result(df):
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()}


def test_query_against_brute_force(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    items = duckdb.sql(f"select item_id, text from '{SF}/benchmark.parquet'").fetchall()
    assert result(queries.QUERIES["op7_decontaminate"](spark, SF)) == brute(rows, items)


ITEMS = [
    (1, "a b c d e f g h i j k l m n o p"),
    (2, "b c d e f g h i j k l m n X"),
    (3, "Short One"),
    (4, "one"),
    (5, None),
    (6, "..."),
    (7, "short one"),
    (None, "z y x"),
    (8, "a a a a a a a a a a a a a a a"),
]
ROWS = [
    (1, "q " * 50 + "A-b.c d e f g h i j k l m n o p q"),
    (2, "a short one here"),
    (3, "x y z y x y"),
    (4, None),
    (5, ""),
    (6, "b c d e f g h i j k l m n"),
    (7, "a " * 40 + "b c d e f g h i j k l m n o"),
    (8, "c d e f g h i j k l m n"),
]


@pytest.mark.parametrize("block", [1, 20, 100_000])
def test_short_items_ties_and_blocks(spark, block):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert result(dc.scan(docs(spark, ROWS), items, block_words=block)) == brute(ROWS, ITEMS)


def test_clean_and_cut(spark):
    items = spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    df = docs(spark, ROWS, extra=True)
    whole = dc.clean(df, items)
    assert whole.columns == df.columns
    contaminated = {d for d, r in brute(ROWS, ITEMS[:1]).items() if r[4]}
    assert contaminated and {r.doc_id for r in whole.collect()} == {d for d, _ in ROWS} - contaminated
    cut = {r.doc_id: r.text for r in dc.clean(df, items, whole=False).collect()}
    assert cut[6] == "" and cut[2] == "a short one here" and cut[4] is None
    assert cut[1].endswith("q  q")


def test_edge_rows(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    df = docs(spark, EDGE, extra=True)
    assert dc.scan(df, items).count() == len(EDGE)
    assert {r.n_hit for r in dc.scan(df, none).collect()} == {0}
    assert dc.scan(docs(spark, []), items).count() == 0
