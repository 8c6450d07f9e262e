import random
import re
import zlib
from collections import Counter

import duckdb

from tests.llm.conftest import EDGE, SF, docs
from txsentry.llm import queries, spelling


def brute_words(rows, min_length=7, min_count=2):
    c = Counter()
    for d, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(x.lower() if "A" <= x <= "Z" else x for x in w)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            c[w] += 1
    return {w: n for w, n in c.items() if len(w) >= min_length and n >= min_count}


def brute_near(words):
    """Near words by deletion neighbourhoods, checked by a plain edit test."""

    def one_edit(a, b):
        if len(a) > len(b):
            a, b = b, a
        if a == b or len(b) - len(a) > 1:
            return False
        i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        return a[i + (len(a) == len(b)) :] == b[i + 1 :]

    by = {}
    for w in words:
        for k in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            by.setdefault(k, []).append(w)
    near = {w: set() for w in words}
    for ws in by.values():
        for i, a in enumerate(ws):
            for b in ws[i + 1 :]:
                if one_edit(a, b):
                    near[a].add(b)
                    near[b].add(a)
    return near


def brute(words):
    near, out = brute_near(words), {}
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return out


def as_dict(rows):
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_against_brute_force(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    want = brute(brute_words(rows))
    assert any(v[0] for v in want.values()) and len(want) > 1000
    got = queries.QUERIES["op13_spelling_variants"](spark, SF)
    assert got.columns[:1] == ["word"]
    assert as_dict(got.collect()) == want


def test_dense_blocks_lose_no_pair(spark):
    """Few letters, many words: blocks are halved down to one place (tile=1 and 20)."""
    rng = random.Random(3)
    words = {"".join(rng.choice("aé") for _ in range(rng.randint(7, 10))): rng.randint(2, 400) for _ in range(900)}
    words |= {"x" * k: 5 for k in range(7, 12)} | {"ab" * 150: 4, "ab" * 150 + "a": 50, "b" + "ab" * 150: 40}
    near = brute_near(words)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    for tile in (1, 20, 1024):
        got = spelling.near_words(df, tile=tile).groupBy("word").agg({"n_near": "sum", "best_n": "max"}).collect()
        assert {r["word"]: (r["sum(n_near)"], r["max(best_n)"]) for r in got} == {w: (len(x), max(words[y] for y in x)) for w, x in near.items() if x}


def test_chains_ties_and_roots(spark):
    text = " ".join(["garden" + "xx"] * 1 + ["gardenx"] * 2 + ["gardeny"] * 2)
    rows = [(i, "gardening " * 25) for i in range(40)] + [(50, "gardenig " * 30 + "Gardenng gardenng " + text * 2)]
    want = brute(brute_words(rows))
    got = as_dict(spelling.variants(docs(spark, rows, extra=True)).collect())
    assert got == want
    assert got["gardenng"][:2] == ("gardening", "gardening")


def test_edge_rows(spark):
    rows = [*EDGE, (8, "Straße straßen STRASSEN ÀÉÎÕÜÿ× ÀÉÎÕÜÿ×"), (None, "words words letters letters"), (None, "letters"), (9, "abcdefgh" * 4000 + " " + "abcdefgh" * 4000 + " x" + "abcdefgh" * 4000 + " x" + "abcdefgh" * 4000)]
    want = brute(brute_words([(r[0], r[1]) for r in rows]))
    assert as_dict(spelling.variants(docs(spark, rows, extra=True)).collect()) == want
    assert spelling.variants(docs(spark, [])).count() == 0
    assert spelling.variants(docs(spark, [(1, None), (2, "")])).count() == 0
