import math
import random
import re
from collections import Counter

import duckdb
import numpy as np

from tests.llm.conftest import EDGE, SF, docs
from txsentry.llm import lexical, queries

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, places=50):
    """rows: (doc_id, text); items: (item_id, text) -> sorted result rows."""
    held = [(d, Counter(terms(t))) for d, t in rows]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n_docs, n_terms = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item_id, text in items:
        found = []
        for d, c, n in held:
            m = 100 - 50 + (50 * n * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in {*terms(text)} if t in c)
            if s > 0:
                found.append((-s, d is None, d))
        found.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item_id, r, d, -s) for r, (s, _, d) in enumerate(found[:places], 1)]
    return sorted(out, key=str)


def got(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_against_brute_force(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    items = duckdb.sql(f"select item_id, text from '{SF}/benchmark.parquet'").fetchall()
    assert got(queries.QUERIES["op11_lexical_search"](spark, SF)) == brute(rows, items)


def test_tree_holds_every_point_and_maximum():
    rng = random.Random(1)
    for rows, cols, n in ((1, 1, 1), (300, 5, 200), (7, 900, 700), (64, 64, 4096)):
        points = {(rng.randrange(rows), rng.randrange(cols)): rng.randint(1, 10**6) for _ in range(n)}
        r, c = (np.array(x, np.int64) for x in zip(*points))
        v = np.array(list(points.values()), np.int64)
        tree = lexical.Treap(*lexical.build_tree(r, c, v))
        assert tree.top[1] == v.max()
        for row in range(min(rows, 20)):
            cols_, scores = tree.best(np.array([row]), np.array([1]), 10**6, 1)
            assert dict(zip(cols_.tolist(), scores.tolist())) == {b: x for (a, b), x in points.items() if a == row}


def test_shards_blocks_ties(spark):
    """Tiny shards and item blocks, many equal scores, all documents asked for or a few."""
    rng = random.Random(9)
    vocab = [f"t{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(vocab[: rng.randint(1, 60)]) for _ in range(rng.randint(0, 25)))) for i in range(300)]
    rows += [(1000 - i, "T1 t2 t3 t59") for i in range(120)] + [(None, "t1 t2 t3 t59"), (5, "t1 t2 t3 t59"), (5, "t1 t2 t3 t59")]
    items = [(i, " ".join(rng.sample(vocab, rng.randint(1, 12)))) for i in range(15)] + [(3, "T59 t1"), (None, "t1"), (90, "absent"), (91, None), (92, "")]
    table = spark.createDataFrame(items, "item_id long, text string")
    for places, shard_terms, shard_docs, block_terms in ((50, 100, 7, 20), (3, 10**6, 64, 10**6), (1000, 40, 1000, 1)):
        df = lexical.rank_documents(docs(spark, rows, extra=True).repartition(3), table, places, shard_terms, shard_docs, block_terms)
        assert got(df) == brute(rows, items, places)


def test_edge_rows(spark):
    items = spark.createDataFrame([(1, "one ñandú"), (2, "x"), (3, "words id 中文")], "item_id long, text string")
    rows = [(r[0], r[1]) for r in EDGE]
    assert got(lexical.rank_documents(docs(spark, EDGE, extra=True), items)) == brute(rows, [tuple(r) for r in items.collect()])
    assert lexical.rank_documents(docs(spark, []), items).count() == 0
    assert lexical.rank_documents(docs(spark, EDGE), items.limit(0)).count() == 0
