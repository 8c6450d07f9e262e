import duckdb

from tests.llm.conftest import EDGE, SF, docs
from txsentry.llm import mixing, queries


def brute_targets(sizes):
    """Water filling by hand: sources in order, weights 1, 2, 3, bound 3 x size."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, held = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in held]
        if not free:
            break
        share = (total - sum(held.values())) / sum(weight[s] for s in free)
        over = [s for s in free if 3 * sizes[s] <= weight[s] * share]
        if not over:
            held |= {s: weight[s] * share for s in free}
            break
        held |= {s: 3.0 * sizes[s] for s in over}
    return held


def test_targets_and_taken(spark):
    rows = queries.QUERIES["op8_mix_sources"](spark, SF).collect()
    truth = duckdb.sql(f"select doc_id, len(regexp_extract_all(text, '[^ \\t-\\r]+')), source from '{SF}/documents.parquet'").fetchall()
    assert {(r.doc_id, r.size, r.source) for r in rows} == set(truth)
    sizes = {}
    for _, n, s in truth:
        sizes[s] = sizes.get(s, 0) + n
    target = brute_targets(sizes)
    taken, longest = {}, {}
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6 * max(1, r.target)
        assert r.taken == r.copies * r.size <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        longest[r.source] = max(longest.get(r.source, 0), r.size)
    for s, t in target.items():
        assert abs(taken[s] - t) <= 3 * longest[s]


def test_small_sources_are_capped(spark):
    rows = [(i, "w " * 100, None, "a") for i in range(50)] + [(100, "w w", None, "b"), (101, "w", None, None), (102, "", None, "z")]
    got = {r.source: r for r in mixing.mix(docs(spark, rows)).collect()}
    want = brute_targets({"a": 5000, "b": 2, "z": 0, None: 1})
    assert {s: round(r.target, 6) for s, r in got.items()} == {s: round(t, 6) for s, t in want.items()}
    assert got["b"].copies == 3 and got[None].copies == 3 and got["z"].taken == 0


def test_edge_rows_and_reruns(spark):
    df = docs(spark, EDGE, extra=True)
    a, b = (sorted(map(str, mixing.mix(x).collect())) for x in (df, df.repartition(3)))
    assert len(a) == len(EDGE) and a == b
    assert mixing.mix(docs(spark, [])).count() == 0 and mixing.emit(docs(spark, [])).count() == 0
    out = mixing.emit(df)
    assert out.columns == [*df.columns, "copy"]
    drawn = sum(r.copies for r in mixing.mix(df).collect())
    assert out.count() == drawn
