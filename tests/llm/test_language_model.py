import collections
import math
import random
import re
import zlib

import duckdb
import numpy as np

from tests.llm.conftest import EDGE, SF, docs
from txsentry.llm import language_model as lm, queries


def tokens(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), "\n"]


def brute(rows):
    toks = {d: tokens(t) for d, t in rows}
    c = collections.Counter()
    for d, ws in toks.items():
        if zlib.crc32(str(d).encode()) % 10:
            c.update(ws)
    n, v = sum(c.values()), len(c)
    return {d: (len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) for d, ws in toks.items()}


def check(got, want):
    for r in got:
        n, known, train, base = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, train)
        assert abs(r.base_score - base) < 1e-6 * abs(base) + 1e-9


def test_query_against_brute_force(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    got = queries.QUERIES["op10_lm_scoring"](spark, SF).collect()
    assert len(got) == len(rows)
    check(got, brute(rows))
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0) and r.score < 0 for r in got)


def test_held_out_text_is_likelier_than_under_the_base(spark):
    got = queries.QUERIES["op10_lm_scoring"](spark, SF.replace("0.001", "0.01")).collect()
    assert sum(r.score for r in got if r.held_out) > sum(r.base_score for r in got if r.held_out)


def test_blocks_do_not_change_counts(spark):
    rows = [(i, " ".join(random.Random(i).choices("abcdefg", k=i))) for i in range(60)]
    for size in (1, 50, 10**6):
        got = lm.log_likelihood(docs(spark, rows).repartition(3), block_tokens=size, shortlist=4, rounds=1).collect()
        assert len(got) == 60
        check(got, brute(rows))


def test_model_is_a_distribution_and_starts_at_the_base():
    counts, tail = np.array([50.1, 20.1, 5.1, 5.1, 2.1]), 3.3
    net = lm.Net(counts, tail, hidden=8, classes=3)
    h = np.random.default_rng(0).standard_normal((4, 8)).astype(np.float32)
    base = np.log(np.append(counts, tail) / (counts.sum() + tail))
    for y in range(6):
        assert np.allclose(net.logp(h, np.full(4, y)), base[y], atol=1e-5)
    for v in net.p.values():
        v += np.random.default_rng(1).standard_normal(v.shape).astype(np.float32)
    assert np.allclose(sum(np.exp(net.logp(h, np.full(4, y))) for y in range(6)), 1, atol=1e-5)


def test_gradients():
    rng = np.random.default_rng(2)
    net = lm.Net(np.array([9.0, 7, 5, 3, 2, 1]), 2.0, hidden=3, classes=3)
    net.p = {n: rng.standard_normal(v.shape) * 0.5 for n, v in net.p.items()}
    x, y = rng.integers(0, 8, (5, 4)), rng.integers(0, 7, (5, 4))
    h0 = rng.standard_normal((4, 3))

    def loss():
        h, total = h0, 0.0
        for t in range(5):
            h, _ = net.step(x[t], h)
            total -= net.logp(h, y[t]).sum()
        return total

    grad, _ = net.window(x, y, h0)
    for n, v in net.p.items():
        for at in rng.integers(0, v.size, 6):
            old = v.flat[at]
            v.flat[at] = old + 1e-5
            up = loss()
            v.flat[at] = old - 1e-5
            down = loss()
            v.flat[at] = old
            assert abs((up - down) / 2e-5 - grad[n].flat[at]) < 1e-4 * max(1, abs(grad[n].flat[at])), n


def test_lanes_carry_the_state_and_reset_it():
    rng = np.random.default_rng(3)
    net = lm.Net(np.arange(12, 2, -1.0), 2.0, hidden=4, classes=3)
    for v in net.p.values():
        v += rng.standard_normal(v.shape).astype(np.float32)
    texts = [rng.integers(0, 11, n) for n in (1, 700, 3, 40, 90, 2, 5)]
    want = []
    for d in texts:
        h, total, last = np.zeros((1, 4), np.float32), 0.0, net.k + 1
        for w in d:
            h, _ = net.step(np.array([last]), h)
            total += float(net.logp(h, np.array([w]))[0])
            last = w
        want.append(total)
    for lanes in (1, 2, 64):
        assert np.allclose(net.score(texts, lanes), want, rtol=1e-4)


def test_training_learns_context():
    """Words alternate, so the model must beat the unigram base by far."""
    net = lm.Net(np.array([1000.1, 999.1, 30.1]), 0.2, hidden=8, classes=2)
    text = [np.array([0, 1] * 40 + [2]) for _ in range(300)]
    before = net.score(text[:5]).sum()
    for _ in range(6):
        net.fit(text, lanes=16)
    assert net.score(text[:5]).sum() > 0.5 * before


def test_long_documents_are_trained_on_to_their_end():
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 4, n) for n in (3000, *[50] * 100, 7, 1)]
    net = lm.Net(np.array([9.0, 7, 5]), 2.0, hidden=4, classes=2)
    assert net.fit(texts, lanes=16) == sum(len(d) for d in texts)
    # the end of a long text teaches something: words alternate there only
    long = np.concatenate([np.full(400, 2), np.tile([0, 1], 3000)])
    net = lm.Net(np.array([9.0, 9, 2]), 0.1, hidden=8, classes=2)
    before = net.score([long]).sum()
    for _ in range(10):
        net.fit([long, *[np.array([2, 2, 2])] * 64], lanes=64)
    assert net.score([long]).sum() > 0.7 * before


def test_places_that_are_not_taken_give_no_gradient():
    rng = np.random.default_rng(5)
    net = lm.Net(np.array([9.0, 7, 5, 3, 2, 1]), 2.0, hidden=3, classes=3)
    net.p = {n: rng.standard_normal(v.shape) * 0.5 for n, v in net.p.items()}
    x, y, h = rng.integers(0, 8, (5, 2)), rng.integers(0, 7, (5, 2)), rng.standard_normal((2, 3))
    on = np.ones((5, 2), bool)
    on[3:, 1] = False
    got, _ = net.window(x, y, h, on)
    parts = [net.window(x[:, :1], y[:, :1], h[:1])[0], net.window(x[:3, 1:], y[:3, 1:], h[1:])[0]]
    for n, g in got.items():
        assert np.allclose(g, parts[0][n] + parts[1][n])


def test_every_training_document_is_trained_on(spark, tmp_path, monkeypatch):
    """Each training document is met in one round, whatever the blocks."""
    rows = [(i, f"w{i} " * 3) for i in range(60)]
    words = [f"w{i}".encode() for i in range(60)]
    fit, log = lm.Net.fit, str(tmp_path)

    def noted(self, docs, *a, **b):
        import os
        import uuid

        with open(os.path.join(log, uuid.uuid4().hex), "w") as f:
            f.writelines(f"{d[0]}\n" for d in docs)
        return fit(self, docs, *a, **b)

    monkeypatch.setattr(lm.Net, "fit", noted)
    want = sorted(i for i, _ in rows if zlib.crc32(str(i).encode()) % 10)
    for size in (30, 10**6):
        found = lm.blocks(docs(spark, rows).repartition(3), size)
        lm.train(found, words, lm.Net(np.full(60, 3.1), 1.0))
        met = []
        for f in tmp_path.iterdir():
            met += [int(x) for x in f.read_text().split()]
            f.write_text("")
        assert sorted(met) == want


def test_edge_rows(spark):
    df = docs(spark, EDGE, extra=True)
    got = lm.log_likelihood(df).collect()
    assert len(got) == len(EDGE)
    by = {r.doc_id: r for r in got}
    assert by[1].n_tokens == by[2].n_tokens == by[6].n_tokens == 1 and by[None].held_out
    assert lm.log_likelihood(docs(spark, [])).count() == 0
    only = lm.log_likelihood(docs(spark, [(None, "a b")])).first()
    assert (only.train_tokens, only.n_known, only.n_tokens) == (0, 0, 3) and abs(only.base_score) < 1e-9


def test_long_documents_cost_their_own_length():
    """One document of a million tokens among 500 short ones: flat memory, each token once, each
    behind the word before it; parts for training of even lanes."""
    import tracemalloc

    rng = np.random.default_rng(6)
    texts = [rng.integers(0, 50, n).astype(np.int32) for n in (1_000_000, *rng.integers(1, 300, 500))]
    total = sum(map(len, texts))
    for level in (False, True):
        tracemalloc.start()
        stream = lm.Lanes(texts, 512, 50, level)
        tokens, seen, steps = 0, np.zeros(len(texts), np.int64), 0
        for x, y, on, of, last in stream.windows():
            tokens += int(on.sum())
            steps += len(x)
            seen += np.bincount(of[on], y[on] + 1, len(texts)).astype(np.int64)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert last and tokens == total and peak < 100e6
        assert seen.tolist() == [int((d + 1).sum()) for d in texts]
        assert steps < (total / 512 + 400 if level else 1_000_001)
    parts = lm.Lanes([np.arange(200, dtype=np.int32)], 1, 500, True), lm.Lanes([np.arange(200, dtype=np.int32), np.arange(200, 240, dtype=np.int32)], 4, 500, True)
    assert all((p.x == np.where(np.isin(p.y, [0, 200]), 501, p.y - 1)).all() for p in parts)


def test_long_rows_agree_with_single_steps():
    """A window holds places along the last axis, so that no pass runs over short rows."""
    rng = np.random.default_rng(3)
    net = lm.Net(np.array([9.0, 7, 5, 3, 2, 1]), 2.0, hidden=3, classes=3)
    for v in net.p.values():
        v += rng.standard_normal(v.shape).astype(np.float32)
    x, y = rng.integers(0, 8, (4, 6)), rng.integers(0, 7, (4, 6))
    states = net.states(x, np.zeros((net.h, 6), np.float32))[0]
    assert states.shape == (net.h, 4, 6) and states[:, 0].strides[-1] == 4
    h = np.zeros((6, net.h), np.float32)
    for t in range(4):
        h, _ = net.step(x[t], h)
        assert np.allclose(states[:, t].T, h, atol=1e-6)
    at = np.array([7, 2, 20])
    got, back = net.outputs(states.reshape(net.h, -1), y.ravel(), at, {n: np.zeros_like(v) for n, v in net.p.items()})
    assert np.allclose(got, net.logp(states.reshape(net.h, -1).T[at], y.ravel()[at]), atol=1e-6)
    assert back[:, at].any() and not np.delete(back, at, axis=1).any()
