"""Document log-likelihood under a gated recurrent language model.

Words are counted over the whole corpus in Spark. The ``SHORTLIST`` most frequent ones
are outputs of a GRU whose softmax is factored into classes of about equal weight: P(word |
history) = P(class | history) P(word | class, history). All other words form one more
class in which a word has its share of the smoothed counts, so the model is a
distribution over all words and starts out as the unigram base.

1. ``blocks``: documents are packed into blocks of about ``BLOCK_TOKENS`` tokens, each
   with its own word list; one written table.
2. ``word_counts``: the blocks' word lists are summed by word (partial sums per block)
   and the counts are sent back to the blocks that use the word. No word list is ever
   held whole by one task or the driver.
3. ``train``: rounds of parameter averaging. Each training document takes part in one
   round: every task trains a copy on its blocks' documents of that round by truncated
   backpropagation in numpy; the copies are averaged by tokens in Spark. The work grows
   with the corpus.
4. ``score``: documents run through the GRU in lanes; the state is carried over windows
   to the end of each document and reset at its start.

Defined cases: null text is the empty text, whose only token is the end; a null id
belongs to the held-out part; with no training documents every word has the base
probability; texts of any length are read whole; repeated rows count and score like
others; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txsentry.llm.common import crc_mod, stage

FOLDS = 10
ADD = 0.1
SHORTLIST = 1024
CLASSES = 32
HIDDEN = 16
BLOCK_TOKENS = 2_000_000
ROUNDS = 2
LANES = 512  # documents scored side by side
TRAIN_LANES = 512
WINDOW = 32  # steps of truncated backpropagation, and of a scoring window
RATE = 0.01  # of steps over up to 64 lanes; wider ones rest on more places and go further
START = 5_000  # tokens that the untrained model counts for in an average
END = b"\n"  # no word holds white space


def blocks(docs: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per block: its documents' ids, folds and lengths, their tokens as numbers
    into the block's word list, and the list with the counts in training documents."""

    def run(batches):
        part, serial, size = TaskContext.get().partitionId(), 0, 0
        ids, held, lens, codes, vocab = [], [], [], [], defaultdict(count().__next__)

        def out():
            tokens = np.concatenate(codes)
            train = np.repeat(~np.array(held, bool), lens)
            # frequent words get small numbers, which pack well
            order = np.argsort(-np.bincount(tokens, minlength=len(vocab)), kind="stable")
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order), dtype=np.int32)
            tokens, listed = place[tokens], list(vocab)
            tf = np.bincount(tokens[train], minlength=len(vocab))
            row = [[f"{part}-{serial}"], [ids], [held], [lens], [pack(tokens)], [[listed[i] for i in order]], [tf.tolist()]]
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(row, pa_schema)], schema.names)

        for b in batches:
            for k, h, t in zip(*(c.to_pylist() for c in b.columns)):
                ws = (t or b"").lower().split()
                ws.append(END)
                codes.append(np.fromiter(map(vocab.__getitem__, ws), np.int32, len(ws)))
                ids.append(k)
                held.append(h)
                lens.append(len(ws))
                size += len(ws)
                if size >= block_tokens:
                    yield out()
                    serial, size = serial + 1, 0
                    ids, held, lens, codes, vocab = [], [], [], [], defaultdict(count().__next__)
        if ids:
            yield out()

    kind = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("block", T.StringType()),
            T.StructField("ids", T.ArrayType(kind)),
            T.StructField("held", T.ArrayType(T.BooleanType())),
            T.StructField("lens", T.ArrayType(T.IntegerType())),
            T.StructField("tokens", T.BinaryType()),
            T.StructField("words", T.ArrayType(T.BinaryType())),
            T.StructField("tf", T.ArrayType(T.LongType())),
        ]
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    pa_schema = list(to_arrow_schema(schema))
    return docs.select("doc_id", (crc_mod("doc_id", FOLDS) == 0).alias("held"), F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def pack(numbers: np.ndarray) -> bytes:
    """Numbers as four planes of bytes: the upper ones are nearly empty and compress away."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


class Net:
    """A GRU with a class-factored softmax; parameters are float32 arrays in ``p``."""

    def __init__(self, counts: np.ndarray, tail: float, hidden: int = HIDDEN, classes: int = CLASSES, seed: int = 10):
        """``counts``: smoothed counts of the shortlist in falling order; ``tail``: those
        of all other words."""
        k = len(counts)
        rng = np.random.default_rng(seed)
        share = np.cumsum(np.sqrt(counts)) if k else np.zeros(0)
        of = np.minimum((share / share[-1] * classes).astype(int), classes - 1) if k else np.zeros(0, int)
        _, of = np.unique(of, return_inverse=True)  # no empty class
        n = int(of.max()) + 1 if k else 0
        self.first = np.searchsorted(of, np.arange(n + 1))  # words of class c: first[c] .. first[c + 1]
        self.cls = np.append(of, n).astype(np.int64)  # the last one is the tail
        self.k, self.n, self.h = k, n, hidden
        mass = np.append(np.bincount(of, counts, n) if k else np.zeros(0), tail)
        word = np.log(counts / mass[of]) if k else np.zeros(0)
        small = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
        self.p = {
            "x": small(k + 2, 3 * hidden),  # by input word; k: tail, k + 1: start
            "u": small(hidden, 3 * hidden),
            "c": np.zeros((n + 1, hidden), np.float32),
            "cb": np.log(mass / mass.sum()).astype(np.float32),
            "w": np.zeros((k, hidden), np.float32),
            "wb": word.astype(np.float32),
        }

    def gates(self, a: np.ndarray, h: np.ndarray, runs: np.ndarray):
        """One step, lanes along the last axis, so that every slice of gates is one flat run:
        from the rows ``a`` of "x" (lanes, 3 * hidden) and the states (hidden, lanes), which
        begin anew where ``runs`` is not set; new states and what the way back needs."""
        H = self.h
        h = h * runs  # a document starts anew
        a = np.ascontiguousarray(a.T)
        g = self.p["u"].T @ h
        zr = a[: 2 * H]
        zr += g[: 2 * H]
        np.negative(zr, out=zr)
        np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        z, r, s = zr[:H], zr[H:], g[2 * H :]
        n = r * s
        n += a[2 * H :]
        np.tanh(n, out=n)
        new = h - n
        new *= z
        new += n
        return new, (h, z, r, s, n)

    def states(self, x: np.ndarray, h: np.ndarray):
        """The states (hidden, steps, lanes) over a window of input words (steps, lanes), which
        documents run on, and what the way back needs."""
        out, kept, runs = np.empty((self.h, *x.shape), np.float32), [], x != self.k + 1
        for t, row in enumerate(x):
            h, back = self.gates(self.p["x"][row], h, runs[t])
            out[:, t] = h
            kept.append(back)
        return out, kept, runs

    def step(self, x: np.ndarray, h: np.ndarray):
        """One step for a row of input words and states (lanes, hidden): new state and what the way back needs."""
        new, back = self.gates(self.p["x"][x], h.T, x != self.k + 1)
        return new.T, (x, *back)

    def logp(self, h: np.ndarray, y: np.ndarray, grad: dict | None = None):
        """Natural log-probability of the words ``y`` (k: some word of the tail) given the
        states; with ``grad`` also the states' gradients, adding those of the outputs."""
        got = self.outputs(h.T, y, np.arange(len(y)), grad)
        return got if grad is None else (got[0], got[1].T)

    def outputs(self, states: np.ndarray, y: np.ndarray, at: np.ndarray, grad: dict | None = None):
        """``logp`` at the places ``at`` of (hidden, places); the gradients are those of all
        places, 0 at others.

        Places are put in order of their class and run along the last axis, so sums over
        classes and words are sums of long rows.
        """
        p, y = self.p, y[at]
        c = self.cls.astype(np.int16)[y]
        order = np.argsort(c, kind="stable")  # short numbers: a radix sort
        cut = np.searchsorted(c[order], np.arange(self.n + 2))
        at, t = at[order], y[order]
        own = np.take(states, at, axis=1, mode="clip")  # all are inside; the default mode checks each row again
        out = p["c"] @ own + p["cb"][:, None]
        out -= out.max(axis=0)
        got = np.empty(len(y), out.dtype)
        for i in range(self.n + 1):
            got[cut[i] : cut[i + 1]] = out[i, cut[i] : cut[i + 1]]
        np.exp(out, out=out)
        z = out.sum(axis=0)
        got -= np.log(z)
        if grad is not None:
            out /= z
            for i in range(self.n + 1):
                out[i, cut[i] : cut[i + 1]] -= 1
            dh = p["c"].T @ out
            grad["c"] += out @ own.T
            grad["cb"] += out.sum(axis=1)
        for i in range(self.n):
            here = slice(cut[i], cut[i + 1])
            lo, hi = self.first[i], self.first[i + 1]
            if cut[i] == cut[i + 1] or hi - lo == 1:
                continue
            e = p["w"][lo:hi] @ own[:, here] + p["wb"][lo:hi, None]
            e -= e.max(axis=0)
            word = (t[here] - lo, np.arange(cut[i + 1] - cut[i]))
            got[here] += e[word]
            np.exp(e, out=e)
            z = e.sum(axis=0)
            got[here] -= np.log(z)
            if grad is not None:
                e /= z
                e[word] -= 1
                dh[:, here] += p["w"][lo:hi].T @ e
                grad["w"][lo:hi] += e @ own[:, here].T
                grad["wb"][lo:hi] += e.sum(axis=1)
        res = np.empty_like(got)
        res[order] = got
        if grad is None:
            return res
        back = np.zeros_like(states)
        for row, d in zip(back, dh):
            row[at] = d
        return res, back

    def window(self, x: np.ndarray, y: np.ndarray, h: np.ndarray, on: np.ndarray | None = None):
        """Gradients of one window (steps, lanes) over its taken places ``on`` (default:
        all), the state after it."""
        H, u = self.h, self.p["u"]
        states, kept, runs = self.states(x, h.T)
        grad = {n: np.zeros_like(v) for n, v in self.p.items()}
        taken = np.arange(x.size) if on is None else np.flatnonzero(on)
        dh = self.outputs(states.reshape(H, -1), y.ravel(), taken, grad)[1]
        dh = dh.reshape(states.shape)
        later, inner = np.zeros_like(kept[0][0]), np.empty((3 * H, x.shape[1]), np.float32)
        dz, dr, dm = inner[:H], inner[H : 2 * H], inner[2 * H :]
        outers = np.empty((3 * H, *x.shape), np.float32)
        for t in reversed(range(len(x))):
            before, z, r, s, n = kept[t]
            d = dh[:, t] + later
            dn = n * n
            np.subtract(1, dn, out=dn)
            dn *= d
            away = 1 - z
            dn *= away
            np.subtract(before, n, out=dz)
            dz *= d
            away *= z
            dz *= away
            np.multiply(dn, r, out=dm)
            np.subtract(1, r, out=dr)
            dr *= dm
            dr *= s
            outers[: 2 * H, t] = inner[: 2 * H]
            outers[2 * H :, t] = dn
            grad["u"] += before @ inner.T
            d *= z
            d += u @ inner
            later = d * runs[t]
        words = x.ravel()
        order = np.argsort(words.astype(np.uint16) if self.k < 2**16 - 2 else words, kind="stable")  # short ones by radix
        first = np.flatnonzero(np.diff(words[order], prepend=-1))
        grad["x"][words[order[first]]] = np.add.reduceat(np.take(outers.reshape(3 * H, -1), order, axis=1, mode="clip"), first, axis=1).T
        return grad, states[:, -1].T

    def fit(self, docs: list[np.ndarray], lanes: int = TRAIN_LANES, rate: float = RATE) -> int:
        """One pass over the documents (arrays of shortlist numbers) by Adam; tokens seen.

        All lanes run to their ends. Where few are left, the gradients of several windows
        make one step, so that a step rests on a quarter of the lanes' places or more.
        """
        stream = Lanes(docs, lanes, self.k, level=True)
        h = np.zeros((stream.width, self.h), np.float32)
        m = {n: np.zeros_like(v) for n, v in self.p.items()}
        s = {n: np.zeros_like(v) for n, v in self.p.items()}
        least = WINDOW * max(1, stream.width // 4)
        seen = t = held = 0
        for x, y, on, _, last in stream.windows():
            grad, h = self.window(x, y, h[: x.shape[1]], on)
            total = {n: total[n] + g for n, g in grad.items()} if held else grad
            held += int(on.sum())
            if held < least and not last:
                continue
            t += 1
            step = rate * max(1.0, (stream.width / 64) ** 0.5) / (1 + t / 400)
            for n, g in total.items():
                g = np.clip(g / held, -1, 1)
                m[n] = 0.9 * m[n] + 0.1 * g
                s[n] = 0.99 * s[n] + 0.01 * g * g
                self.p[n] -= (step * (m[n] / (1 - 0.9**t)) / (np.sqrt(s[n] / (1 - 0.99**t)) + 1e-6)).astype(np.float32)
            seen, held = seen + held, 0
        return seen

    def score(self, docs: list[np.ndarray], lanes: int = LANES) -> np.ndarray:
        """Natural log-probability of each document (tail words: of the tail class)."""
        total = np.zeros(len(docs))
        stream = Lanes(docs, lanes, self.k)
        h = np.zeros((stream.width, self.h), np.float32)
        for x, y, on, of, _ in stream.windows():
            states = self.states(x, h[: x.shape[1]].T)[0]
            h, on = states[:, -1].T, np.flatnonzero(on)
            total += np.bincount(of.ravel()[on], self.outputs(states.reshape(self.h, -1), y.ravel(), on), len(docs))
        return total

    def state(self) -> dict:
        return vars(self)

    @classmethod
    def of(cls, state: dict) -> Net:
        """A copy of a net from its plain attributes (as broadcast)."""
        net = cls.__new__(cls)
        net.__dict__.update(state)
        net.p = {n: v.copy() for n, v in state["p"].items()}
        return net

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.p.values()])

    def load(self, values: np.ndarray) -> Net:
        at = 0
        for n, v in self.p.items():
            self.p[n] = values[at : at + v.size].astype(np.float32).reshape(v.shape)
            at += v.size
        return self


class Lanes:
    """Documents laid end to end in lanes of about equal length, the longest lane first, and
    handed out in windows of ``WINDOW`` steps over the lanes that are still running.

    Only flat arrays of the documents' own size are held, so one very long document costs its
    own length, not its length times the lanes. The input at a document's first word is
    the start sign. With ``level`` documents are cut where they exceed an even share of a
    lane; a later part begins with the word before it and without state.
    """

    def __init__(self, docs: list[np.ndarray], lanes: int, k: int, level: bool = False):
        sizes = [len(d) for d in docs]
        self.width = max(1, min(lanes, len(docs))) if sum(sizes) else 0
        self.start = k + 1
        if not self.width:
            return
        share = max(WINDOW, -(-sum(sizes) // self.width)) if level else max(sizes)
        parts = [(d, lo, min(share, n - lo)) for d, n in enumerate(sizes) for lo in range(0, n, share)]
        heap, load, own = [(0, i) for i in range(self.width)], [0] * self.width, [[] for _ in range(self.width)]
        for part in sorted(parts, key=lambda p: -p[2]):
            n, i = heapq.heappop(heap)
            own[i].append(part)
            load[i] = n + part[2]
            heapq.heappush(heap, (load[i], i))
        order = sorted(range(self.width), key=lambda i: -load[i])
        self.load = np.array([load[i] for i in order])
        self.begin = np.cumsum(self.load) - self.load
        self.x, self.y, self.of = (np.empty(int(self.load.sum()), np.int32) for _ in range(3))
        at = 0
        for i in order:
            for d, lo, n in own[i]:
                self.y[at : at + n] = docs[d][lo : lo + n]
                self.x[at] = docs[d][lo - 1] if lo else self.start
                self.x[at + 1 : at + n] = docs[d][lo : lo + n - 1]
                self.of[at : at + n] = d
                at += n

    def windows(self):
        """Per window inputs, targets, which places are taken and by which document, each
        (steps, running lanes), and whether it is the last one."""
        end = int(self.load[0]) if self.width else 0
        for lo in range(0, end, WINDOW):
            live = int(np.searchsorted(-self.load, -lo, side="left"))
            steps = lo + np.arange(min(WINDOW, end - lo))[:, None]
            on = steps < self.load[:live]
            at = np.where(on, self.begin[:live] + steps, 0)
            yield np.where(on, self.x[at], self.start), self.y[at], on, self.of[at], lo + WINDOW >= end


def word_counts(found: DataFrame) -> DataFrame:
    """(word, c) over all training documents, from the blocks' lists."""
    each = found.select(F.explode(F.arrays_zip("words", "tf")).alias("e")).select(F.col("e.words").alias("word"), F.col("e.tf").alias("tf"))
    return each.groupBy("word").agg(F.sum("tf").alias("c"))


def _coder(words: list[bytes]):
    """Shortlist numbers of a block's word list."""
    known = {w: i for i, w in enumerate(words)}
    return lambda listed: np.fromiter((known.get(w, len(words)) for w in listed), np.int32, len(listed))


def _cut(tokens: np.ndarray, lens: np.ndarray) -> list[np.ndarray]:
    return np.split(tokens, np.cumsum(lens)[:-1]) if len(lens) else []


def train(found: DataFrame, words: list[bytes], net: Net, rounds: int = ROUNDS) -> Net:
    """Average the copies that the tasks trained, round by round; a round takes every
    ``rounds``-th document of a block, so each is met once."""
    spark = found.sparkSession
    for turn in range(rounds if words else 0):
        sent = spark.sparkContext.broadcast((words, net.state()))  # bounded by the shortlist

        def run(batches, sent=sent, turn=turn):
            words, state = sent.value
            net, code, seen = Net.of(state), _coder(words), 0
            for b in batches:
                for tokens, listed, lens, held in zip(*(b.column(i) for i in range(4))):
                    lens = lens.values.to_numpy()
                    serial = np.arange(len(lens))
                    use = ~np.array(held.as_py(), bool) & (serial % rounds == turn)
                    if use.any():
                        codes = code(listed.as_py())[unpack(tokens.as_py())]
                        seen += net.fit([d for d, u in zip(_cut(codes, lens), use) if u])
            if seen:
                values = net.flat().astype(np.float64) * seen
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values) + 1), pa.int32()), pa.array(np.append(values, seen))], ["at", "v"])

        summed = found.select("tokens", "words", "lens", "held").mapInArrow(run, "at int, v double")
        got = summed.groupBy("at").agg(F.sum("v").alias("v")).toPandas().sort_values("at")["v"].to_numpy()  # the parameters
        if len(got):
            net = Net.of(net.state()).load((got[:-1] + START * net.flat()) / (got[-1] + START))
    return net


def log_likelihood(docs: DataFrame, block_tokens: int = BLOCK_TOKENS, shortlist: int = SHORTLIST, rounds: int = ROUNDS) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType
    found = stage(blocks(docs, block_tokens), "lm-blocks")
    counts = stage(word_counts(found), "lm-counts")
    n, v = counts.filter("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    top = counts.filter("c > 0").orderBy(F.desc("c"), "word").limit(shortlist).collect()
    words = [bytes(r["word"]) for r in top]
    smooth = np.array([r["c"] + ADD for r in top], float)
    whole = n + ADD * (v + 1)
    tail = whole - smooth.sum()
    net = train(found, words, Net(smooth, tail), rounds)
    sent = spark.sparkContext.broadcast((words, net.state()))  # bounded by the shortlist

    listed = found.select("block", F.posexplode("words").alias("at", "word"))
    places = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "top binary, short int")
    numbered = counts.join(F.broadcast(places), counts["word"] == places["top"], "left").select("word", "c", F.coalesce("short", F.lit(len(words))).alias("short"))
    used = listed.join(numbered, "word").select(F.col("block").alias("b"), "at", "c", "short")
    bodies = found.select("block", "ids", "held", "lens", "tokens")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        words, state = sent.value
        net = Net.of(state)
        parts = []
        for i in range(left.num_rows):  # one row
            ids, held, lens = (left.column(c)[i].values for c in (1, 2, 3))
            lens = lens.to_numpy()
            tokens = unpack(left.column(4)[i].as_py())
            at, size = right.column(1).to_numpy(), right.num_rows
            c, short = np.zeros(size, np.int64), np.full(size, len(words), np.int32)
            c[at] = right.column(2).to_numpy()
            short[at] = right.column(3).to_numpy()
            starts = np.concatenate(([0], np.cumsum(lens)[:-1]))
            base = np.log((c + ADD) / whole)
            rest = np.where(short == len(words), np.log((c + ADD) / tail), 0.0)
            score = net.score(_cut(short[tokens], lens)) + np.add.reduceat(rest[tokens], starts)
            cols = [
                ids,
                held,
                pa.array(lens, pa.int64()),
                pa.array(np.add.reduceat((c > 0).astype(np.int64)[tokens], starts), pa.int64()),
                pa.array(np.full(len(lens), n), pa.int64()),
                pa.array(np.add.reduceat(base[tokens], starts) / np.log(10)),
                pa.array(score / np.log(10)),
            ]
            parts.append(pa.table(cols, names=out.names))
        return pa.concat_tables(parts)

    out = T.StructType(
        [
            T.StructField("doc_id", kind),
            T.StructField("held_out", T.BooleanType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_known", T.LongType()),
            T.StructField("train_tokens", T.LongType()),
            T.StructField("base_score", T.DoubleType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    return bodies.groupBy("block").cogroup(used.groupBy("b")).applyInArrow(run, out)
