import hashlib
import random
import unicodedata

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import EDGE, SF, docs
from txsentry.llm import bpe, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def coder():
    return bpe.Encoder(bpe.load(PATH))


def digest(s):
    return hashlib.sha256(s.encode()).hexdigest()


def per_text(coder, texts):
    ids, count = coder.encode(texts)
    out, at = [], 0
    for n in count.tolist():
        out.append(ids[at : at + n].tolist())
        at += n
    assert at == len(ids)
    return out


def test_query_against_the_library(spark, reference):
    rows = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    got = queries.QUERIES["op12_bpe_roundtrip"](spark, SF).collect()
    assert len(got) == len(rows)
    have = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got}
    for d, t in rows:
        ids = reference.encode(t or "", add_special_tokens=False).ids
        assert have[d] == (len(ids), digest(" ".join(map(str, ids))), digest(reference.decode(ids, skip_special_tokens=False)))


def test_every_code_point(coder, reference):
    """Alone, between letters, and doubled: case, composition, class and bytes of each that
    Python's character tables know."""
    known = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) != "Cn"]
    texts = [" ".join(f"{c} a{c}b {c}{c}" for c in known[i : i + 64]) for i in range(0, len(known), 64)]
    assert per_text(coder, texts) == [x.ids for x in reference.encode_batch(texts, add_special_tokens=False)]


def test_random_words(coder, reference):
    rng = random.Random(2)
    texts = ["".join(rng.choice("aabeinrst' 1.é\nÑ") for _ in range(rng.randint(0, 400))) for _ in range(2000)]
    texts += ["a" * n for n in range(1, 300)] + ["ab" * n for n in range(1, 200)] + ["=" * n for n in range(1, 300)]
    texts += ["ΣΑΣ Σ ΟΔΟΣ ΣΣ", "İstanbul İ", "é É é", "don't I'LL 'S ''s 'sx", "<|endoftext|>", "a<|startoftext|>b <|END|> <|endoftext|", "  x\u0085y\x1cz​"]
    assert per_text(coder, texts) == [x.ids for x in reference.encode_batch(texts, add_special_tokens=False)]


def test_long_words_and_a_full_table(coder, reference, monkeypatch):
    rng = random.Random(4)
    texts = ["".join(rng.choice("etaoinshr") for _ in range(n)) for n in (255, 256, 257, 258, 5000)] + ["the" * 3000, "a" * 4001, "=-" * 1000]
    monkeypatch.setattr(bpe, "KEPT", 3)
    for _ in range(2):
        assert per_text(coder, texts) == [x.ids for x in reference.encode_batch(texts, add_special_tokens=False)]


def test_edge_rows(spark, reference):
    df = docs(spark, EDGE, extra=True)
    out = bpe.decode(bpe.encode(df, PATH, keep=["doc_id", "score"]), PATH)
    assert out.columns == ["doc_id", "score", "ids", "decoded"]
    got = sorted((str(r.doc_id), r.ids, r.decoded) for r in out.collect())
    want = []
    for d, t, *_ in EDGE:
        ids = reference.encode(t or "", add_special_tokens=False).ids
        want.append((str(d), ids, reference.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want)
    assert bpe.decode(bpe.encode(docs(spark, []), PATH), PATH).count() == 0
    odd = spark.createDataFrame([(1, [320, 999999, -1, 49407]), (2, None), (3, [])], "k int, ids array<int>")
    assert {r.k: r.decoded for r in bpe.decode(odd, PATH).collect()} == {1: reference.decode([320]) + " <|endoftext|>", 2: "", 3: ""}
