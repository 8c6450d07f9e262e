import zlib

from tests.llm.conftest import EDGE, SF, docs
from txsentry.llm import language_id as li, queries


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.QUERIES["op4_language_id"](spark, SF).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out and truth[r.doc_id].text and truth[r.doc_id].lang]
    assert sum(r.lang_pred == truth[r.doc_id].lang for r in held) > 0.97 * len(held)


def test_grams_of_a_text_do_not_depend_on_its_neighbours():
    texts = ["Abc, def", "", "x", "éa 9 ñ", "..."]
    bins, starts, has = li.grams(texts)
    ends = [*starts[1:], bins.shape[1]]
    for i, t in enumerate(texts):
        own, _, own_has = li.grams([t])
        assert (bins[:, starts[i] : ends[i]] == own).all() and has[i] == own_has[0]
    assert has.tolist() == [True, False, True, True, False]


def test_counts_are_whole(spark):
    rows = [(i, "abc " * (i + 1), "en") for i in range(20)]
    got = {(r.lang, r.bin): r.n for r in li.counts(docs(spark, rows).repartition(4)).collect()}
    assert got[("en", -1)] == 20
    assert sum(n for (_, b), n in got.items() if b >= 0) == sum(li.grams([t])[0].size for _, t, _ in rows)


def test_edge_rows(spark):
    df = docs(spark, [*EDGE, (10, "12 34 !?", "en")], extra=True)
    got = {r.doc_id: r for r in li.language_id(df).collect()}
    assert [got[d].lang_pred for d in (1, 2, 6, 10)] == ["und"] * 4
    assert got[1].score == 0.0 and 0 < got[3].score <= 1
    assert {r.lang_pred for r in li.language_id(docs(spark, [(1, "abc", None)])).collect()} == {"und"}
    assert li.language_id(docs(spark, [])).count() == 0
