import random

from pyspark.sql import functions as F

import corpus_pipeline as cp
from tests.llm.conftest import EDGE, SF, docs
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_line_dedup import brute as lines
from tests.llm.test_simhash import brute_components, brute_fp
from txsentry.llm import mixing, toxicity
from txsentry.llm.common import stage, table


def rows_of(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_against_brute_force(spark):
    """Each stage on all that its predecessor kept."""
    documents = table(spark, SF, "documents")
    held, columns = documents, documents.columns
    for name, step in cp.STAGES:
        before = rows_of(held)
        out = stage(step(spark, held, SF), f"test-{name}")
        after = rows_of(out)
        if name == "toxicity":
            scored = toxicity.toxicity(held, table(spark, SF, "labels"))
            assert set(after) == {r.doc_id for r in scored.collect() if not r.predicted} and len(after) > 0.8 * len(before)
        elif name == "line_dedup":
            want = lines(spark, [(d, t) for d, t in before.items() if t is not None])
            assert after == {d: want[d][0] if t is not None else None for d, t in before.items()}
            assert out.filter("text is not null and n_chars <> length(text)").count() == 0
        elif name == "simhash_neardup":
            comp = brute_components({d: brute_fp(t) for d, t in before.items()}, 2)
            assert set(after) == set(comp.values())
        elif name == "decontamination":
            items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
            assert set(after) == {d for d, r in contaminated(before.items(), items).items() if not r[4]}
        else:
            drawn = {r.doc_id: r.copies for r in mixing.mix(held).collect() if r.copies}
            assert {r.doc_id: r["n"] for r in out.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()} == drawn
            assert out.columns == [*columns, "copy"]
            break
        assert out.columns == columns
        held = out


def test_run_gives_the_stages_rows(spark):
    got = cp.run(spark, SF)
    assert got.count() > 0 and got.columns[:5] == table(spark, SF, "documents").columns
    assert [n for n, _ in cp.STAGES] == ["toxicity", "line_dedup", "simhash_neardup", "decontamination", "mixing"]


def test_planted_cases(spark, tmp_path):
    """Copies, near copies, benchmark passages, shared passages and toxic text planted
    among clean documents: all are caught, and the clean ones stay as they are."""
    rng = random.Random(7)
    vocab = ["".join(rng.choice("abcdefghijklmnoprstuv") for _ in range(rng.randint(3, 9))) for _ in range(4000)]

    def prose(n):
        out = []
        while len(out) < n:
            s = [rng.choice(vocab) for _ in range(rng.randint(6, 14))]
            out += [s[0].capitalize(), *s[1:-1], s[-1] + "."]
        return " ".join(out)

    clean = {i: prose(150) + "\n" + prose(120) for i in range(200)}
    base = prose(300)
    copies = {1000 + i: base for i in range(5)}
    item, shared = prose(40), prose(70)
    leaked = {2000 + i: f"{prose(60)} {item} {prose(60)}" for i in range(3)}
    passage = {3000 + i: f"{prose(80)} {shared} {prose(80)}" for i in range(4)}
    toxic = {4000 + i: " ".join(w + (" zzgrol" + rng.choice(vocab)[:3] if k % 20 == 5 else "") for k, w in enumerate(prose(100).split())) for i in range(60)}
    everything = {**clean, **copies, **leaked, **passage, **toxic}
    df = docs(spark, [(k, v, "en", f"s{k % 3}") for k, v in everything.items()]).coalesce(4)
    sf = str(tmp_path / "sf")
    df.write.parquet(f"{sf}/documents.parquet")
    labels = [(k, 0, int(k in toxic)) for k in everything if k in toxic or k < 200]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, item), (2, prose(30))], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    held = table(spark, sf, "documents")
    for name, step in cp.STAGES[:4]:
        held = stage(step(spark, held, sf), f"planted-{name}")
    got = rows_of(held)
    assert {k: got.get(k) for k in clean} == clean
    assert not set(toxic) & set(got)
    # line dedup leaves the repeated passage in its first document only, and that one goes
    assert 2000 not in got and not any(r[4] for r in contaminated(got.items(), [(1, item)]).values())
    assert [k for k in copies if got.get(k) == base] == [1000] and not any(got.get(k) for k in copies if k != 1000)
    middle = shared[len(shared) // 3 : 2 * len(shared) // 3]
    assert sum(middle in t for t in got.values() if t) == 1


def test_edge_rows_and_empty_tables(spark, tmp_path):
    sf = str(tmp_path / "sf")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    for rows in (EDGE, []):
        held = docs(spark, rows, extra=True)
        for name, step in cp.STAGES:
            held = stage(step(spark, held, sf), f"edge-{name}")
        assert (held.count() > 0) == bool(rows)
