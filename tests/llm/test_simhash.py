import random
import re

import duckdb
import numpy as np
import xxhash

from tests.llm.conftest import EDGE, SF, docs
from txsentry.llm import common, queries, simhash


def brute_fp(text, k=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    ws = re.findall(r"[^\x20\x09-\x0D]+", low)
    k = min(k, len(ws))
    hs = [xxhash.xxh64_intdigest(" ".join(ws[i : i + k]).encode(), 42) for i in range(len(ws) - k + 1)] if ws else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, bits):
    """fps: {id: fingerprint} -> {id: smallest id reachable}."""
    up = {i: i for i in fps}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = list(fps)
    v = np.array([fps[i] for i in ids], np.uint64)
    for i, a in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(v[i + 1 :] ^ v[i]) <= bits):
            x, y = find(a), find(ids[i + 1 + j])
            up[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_query_against_brute_force(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    fps = {d: brute_fp(t) for d, t in rows}
    want = brute_components(fps, 2)
    got = queries.QUERIES["op5_simhash_neardup"](spark, SF).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {d: (f"{fps[d]:016x}", want[d]) for d in fps}


def test_trie_join_loses_no_link(spark):
    """Dense and sparse fingerprints, heavy nodes down to the last level (piece=8)."""
    rng = random.Random(5)
    values = {rng.getrandbits(64) for _ in range(300)}
    centre = rng.getrandbits(64)
    for _ in range(300):  # a dense group: few bits away from each other
        x = centre
        for b in rng.sample(range(64), rng.randint(0, 5)):
            x ^= 1 << b
        values.add(x)
    values |= {0, 1, (1 << 64) - 1, (1 << 64) - 2, 1 << 63}
    for bits in (0, 1, 2, 3):
        signed = [v - (1 << 64) if v >> 63 else v for v in values]
        fps = spark.createDataFrame([(v,) for v in signed], "fp long")
        links = common.components(simhash.trie_links(fps, bits, piece=40), "t").collect()
        got = {r.node: r.root for r in links}
        want = brute_components({v: v % (1 << 64) for v in signed}, bits)
        linked = {v for v in want if want[v] != v} | set(want.values()) & {want[v] for v in want if want[v] != v}
        assert got == {v: want[v] for v in linked}


def test_components_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1001 + i) for i in range(300)] + [(5000, 5000)]
    got = {r.node: r.root for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1301)}}


def test_edge_rows_and_keep_first(spark):
    df = docs(spark, EDGE, extra=True)
    got = simhash.near_duplicates(df).collect()
    assert len(got) == len(EDGE)
    by = {r.doc_id: r for r in got}
    assert by[1].fp == 0 and {by[1].component_id, by[2].component_id, by[6].component_id} == {1}
    assert simhash.near_duplicates(docs(spark, [])).count() == 0
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids, key=str) == sorted([1, 3, None, 5, 7], key=str)
    assert simhash.keep_first(docs(spark, [])).count() == 0


def test_near_copies_are_linked(spark):
    rng = random.Random(1)
    words = [f"w{rng.randrange(5000)}" for _ in range(3000)]
    near = [*words[:1500], "changed", *words[1501:]]
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs(spark, [(4, " ".join(words)), (9, " ".join(near)), (8, " ".join(reversed(words)))])).collect()}
    assert got == {4: 4, 9: 4, 8: 8}
