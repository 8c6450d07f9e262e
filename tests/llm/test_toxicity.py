import random
import zlib

import numpy as np

from tests.llm.conftest import EDGE, docs
from txsentry.llm import toxicity as tx


def corpus(spark, n=1500, seed=3):
    """Invented prose; toxic rows hold words that begin with an invented stem."""
    rng = random.Random(seed)
    common = ["".join(rng.choice("abdeghilmnorstu") for _ in range(rng.randint(2, 9))) for _ in range(800)]
    rows, labels = [], []
    for i in range(n):
        ws = [rng.choice(common) for _ in range(rng.randint(5, 80))]
        toxic = i % 8 == 0
        if toxic:
            for _ in range(1 + len(ws) // 25):
                ws.insert(rng.randrange(len(ws)), "zwrk" + rng.choice(common)[:3])
        rows.append((i, " ".join(ws)))
        if i % 3:
            labels.append((i, 0, int(toxic)))
    return docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows


def test_held_out_rows_are_told_apart(spark):
    df, labels, rows = corpus(spark)
    got = {r.doc_id: r for r in tx.toxicity(df, labels).collect()}
    assert len(got) == len(rows)
    held = [r for r in got.values() if r.held_out]
    assert {r.doc_id for r in held} == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got.values())
    right = [r.predicted == int(r.doc_id % 8 == 0) for r in held]
    assert np.mean(right) > 0.97
    assert np.mean([r.predicted for r in held if r.doc_id % 8]) < 0.02


def test_labels_of_held_out_rows_are_not_used(spark):
    df, labels, _ = corpus(spark, 400)
    flipped = labels.selectExpr("doc_id", "quality", "case when pmod(crc32(cast(cast(doc_id as string) as binary)), 5) = 0 then 1 - toxic else toxic end toxic")
    a, b = ({r.doc_id: round(r.score, 9) for r in tx.toxicity(df, x).collect()} for x in (labels, flipped))
    assert a == b


def test_label_model_finds_accuracies_and_discounts_copies():
    rng = np.random.default_rng(0)
    y = rng.random(6000) < 0.3

    def voter(right, speak=0.8):
        v = np.where(rng.random(6000) < right, y, ~y).astype(int)
        return np.where(rng.random(6000) < speak, v, 2)

    v = np.stack([voter(0.9), voter(0.85), voter(0.8), voter(0.75)], 1)
    v = np.concatenate([v, v[:, 3:], v[:, 3:]], 1)  # two copies of the worst voter
    model = tx.LabelModel(6, 0.3).fit(v, np.ones(6000))
    acc = model.accuracies
    assert acc[0] > acc[2] > 0.7
    assert model.share[5] < 0.6 < model.share[0]
    assert np.mean((model.posterior(v) > 0.5) == y) > 0.88


def test_labelled_documents_come_first_in_the_sample(spark):
    df = docs(spark, [(i, f"text {i}") for i in range(3000)])
    marked = range(0, 3000, 30)
    labels = spark.createDataFrame([*[(i, 0, i // 30 % 2) for i in marked], (1, 0, None), (9999, 0, 1)], "doc_id long, quality int, toxic int")
    want = {f"text {i}": i // 30 % 2 for i in marked if zlib.crc32(str(i).encode()) % 5}
    got = tx._sample(df, labels, 400).collect()
    assert {r.text: r.label for r in got if r.label is not None} == want
    assert 330 < len(got) < 470 and len({r.text for r in got}) == len(got)
    # more labelled rows than the bound: a sample of them and no others
    got = tx._sample(df, labels, 40).collect()
    assert 20 < len(got) < 60 and all(want[r.text] == r.label for r in got)
    # all fit
    assert tx._sample(df, labels, 10**6).count() == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(3000))


def test_edge_rows(spark):
    labels = spark.createDataFrame([(3, 1, 0), (5, 0, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    df = docs(spark, [*EDGE, (8, "you idiot, you pathetic loser, stupid worthless scum")], extra=True)
    for lab in (labels, labels.limit(0)):
        got = tx.toxicity(df, lab).collect()
        assert len(got) == len(EDGE) + 1
        by = {r.doc_id: r.score for r in got}
        assert by[1] == by[2] < by[8]
        assert {r.held_out for r in got if r.doc_id is None} == {True}
    assert tx.toxicity(docs(spark, []), labels).count() == 0
