import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import EDGE, SF, docs
from txsentry.llm import merkle, queries


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def brute_root(text):
    import re

    sections = []
    for s in re.split(r"(?<=\n\n)", text):
        sections.append(sha(",".join(sha(p) for p in re.split(r"(?<=\n)", s) if p or s == "")))
    return sha(",".join(sections))


@pytest.mark.parametrize("bucket", [1, 7, 512])
def test_next_document_and_edit(spark, bucket):
    truth = sorted(duckdb.sql(f"select doc_id, coalesce(text, '') from '{SF}/documents.parquet'").fetchall(), reverse=True)
    got = {r.doc_id: r for r in merkle.followed(spark.read.parquet(f"{SF}/documents.parquet"), bucket_rows=bucket).collect()}
    assert len(got) == len(truth)
    for i, (d, t) in enumerate(truth):
        assert (got[d].text, got[d].next_text) == (t, truth[(i + 1) % len(truth)][1])


def test_query_against_brute_force(spark):
    truth = sorted(duckdb.sql(f"select doc_id, coalesce(text, '') from '{SF}/documents.parquet'").fetchall(), reverse=True)
    got = {r.doc_id: r for r in queries.QUERIES["op2_merkle_fingerprints"](spark, SF).collect()}
    for i, (d, t) in enumerate(truth):
        k = len(t) // 3
        edited = t[: len(t) - k] + truth[(i + 1) % len(truth)][1][:k]
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), sha(edited))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.fingerprint == r.edited_fingerprint) == (t == edited)
    long = [r for r in got.values() if r.n_chars > 500]
    assert all(r.near_edited > r.near_next for r in long)
    assert sum(r.near_edited > 0.5 for r in long) > 0.9 * len(long)


def test_tree(spark):
    texts = ["a", "a\nb", "a\n\nb", "a\nb\n", "", "é\n\n\nx"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", merkle.root(F.col("t")).alias("r"))
    roots = {r.t: r.r for r in df.collect()}
    assert len(set(roots.values())) == len(texts)
    assert roots["a\nb"] == sha(sha(",".join([sha("a\n"), sha("b")])))
    d = spark.createDataFrame([("a\nb\nc", "a\nX\nc")], "a string, b string").select(merkle.differing(F.col("a"), F.col("b")).alias("d")).first().d
    assert d == [1]


def test_every_script_has_pieces(spark):
    import random

    rng = random.Random(6)

    def words(signs, blank):
        return lambda: blank.join("".join(rng.choice(signs) for _ in range(rng.randint(2, 8))) for _ in range(200))

    cjk = [chr(c) for c in range(0x4E00, 0x5200)]
    kinds = {
        "cjk": lambda: "。".join("".join(rng.choice(cjk) for _ in range(rng.randint(8, 20))) for _ in range(40)),
        "cyrillic": words([chr(c) for c in range(0x430, 0x450)], " "),
        "capitals": words("ABCDEFGHIJKLMNOPQRSTUVWXYZ", " "),
        "numbers": words("0123456789", " "),
        "no blanks": words("acgt", ""),
    }
    rows = []
    for make in kinds.values():
        a, b = make(), make()
        rows.append((a, a[: len(a) * 2 // 3] + b[: len(a) // 3], b))
    likeness = [merkle.likeness(merkle.pieces(F.col("a")), merkle.pieces(F.col(c)), F.lit(False)).alias(c) for c in "bc"]
    for kind, r in zip(kinds, spark.createDataFrame(rows, "a string, b string, c string").coalesce(1).select(*likeness).collect()):
        assert 0.5 < r.b < 0.8 and r.c < 0.4, (kind, r)


def test_a_long_piece_has_its_true_length(spark):
    df = spark.createDataFrame([("\u00e9" + "x" * 1_500_000,)], "t string")
    assert df.select(merkle._weight(merkle.pieces(F.col("t"))).alias("n")).first().n > 1_490_000


def test_edge_rows(spark):
    df = docs(spark, EDGE, extra=True)
    got = merkle.fingerprints(df).collect()
    assert len(got) == len(EDGE)
    same = [r for r in got if r.doc_id == 3]
    assert same[0].fingerprint == same[1].fingerprint
    by = {r.doc_id: r for r in got}
    assert by[1].n_chars == 0 and by[1].fingerprint == by[2].fingerprint
    assert merkle.fingerprints(docs(spark, [])).count() == 0
    alone = merkle.fingerprints(docs(spark, [(9, "abcdef")])).first()
    assert alone.edited_sha256 == sha("abcdab") and alone.near_next == 1.0
