"""Benchmark decontamination with a generalised suffix automaton.

The words of all test items are put into one automaton whose states are the classes of
word sequences that end at the same places of the items. A document's words are
streamed through it: at each word the automaton knows the longest ending sequence that
occurs in an item. Where that length reaches ``window`` words, the last ``window`` words
are a window of some item; where it covers a whole shorter item, that item occurs. Words
inside such an occurrence are hit. A document is contaminated if it has a hit and hits
make up ``1 / coverage`` of its words or more.

A match of n words needs n words in a row that items use at all, so only such runs, of
at least the shortest window, are streamed; all other words cannot be part of a match.

The test items are a stated query set: the automaton is built on the driver in blocks
of at most ``block_words`` words, each broadcast, and every document meets every block.

Defined cases: null text has no words and is not contaminated; an item without words
(or null) is never found; items with equal text are all reported; a null item id is
left out of the reported ids but its words count; repeated rows get equal results; empty tables give
empty results, or no hits where only the items are missing; extra columns are kept.
"""

from __future__ import annotations

import hashlib
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txsentry.llm.common import packed

WINDOW = 13
COVERAGE = 20  # contaminated from one hit word in 20
BLOCK_WORDS = 100_000

# word signs: digits, letters and everything beyond ASCII; A-Z are lower-cased
_TO_WORDS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))
_RUN = re.compile(rb"[\x30-\x39\x41-\x5A\x61-\x7A\x80-\xFF]+")


def words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TO_WORDS).split()


class Automaton:
    """Generalised suffix automaton over the word sequences of items."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        ends: list[set] = [set()]  # items that pass through a state
        whole: dict[int, list] = {}  # state -> (length, item) of short items that end there
        items = [(k, [self.vocab.setdefault(w, len(self.vocab)) for w in ws]) for k, ws in items if ws]
        for k, ids in items:
            last = 0
            for w in ids:
                last = self._extend(last, w)
                while len(ends) < len(self.len):
                    ends.append(set())
                ends[last].add(k)
        # an item that passes through a state passes through all its suffix links
        for s in sorted(range(1, len(self.len)), key=lambda s: -self.len[s]):
            if self.link[s] > 0:
                ends[self.link[s]] |= ends[s]
        for k, ids in items:
            if len(ids) < window:
                s = 0
                for w in ids:
                    s = self.next[s][w]
                whole.setdefault(s, []).append((len(ids), k))
        #: per state: the items of its windows (of the state on its link path that holds length ``window``)
        self.found: list[tuple] = [()] * len(self.len)
        #: per state: (length, item) of whole short items that are suffixes of it
        self.short: list[list] = [[]] * len(self.len)
        for s in sorted(range(1, len(self.len)), key=lambda s: self.len[s]):
            up = self.link[s]
            self.short[s] = self.short[up] + whole[s] if s in whole else self.short[up]
            if self.len[s] >= window:
                self.found[s] = self.found[up] if self.len[up] >= window else tuple(ends[s])
        self.least = min([min(len(ids), window) for _, ids in items], default=0)

    @classmethod
    def of(cls, state: dict) -> Automaton:
        """An automaton from the plain attributes of another (as broadcast)."""
        out = cls.__new__(cls)
        out.__dict__.update(state)
        return out

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        if w in nxt[last]:
            q = nxt[last][w]
            return q if length[q] == length[last] + 1 else self._split(last, w, q)
        new = len(length)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p != -1:
            q = nxt[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, w, q)
        return new

    def _split(self, p: int, w: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        twin = len(length)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = twin
        while p != -1 and nxt[p].get(w) == q:
            nxt[p][w] = twin
            p = link[p]
        return twin

    def stream(self, text: bytes | None) -> tuple[int, list[tuple[int, int]], set]:
        """Number of words, ranges [a, b) of hit words (ascending, may overlap), items."""
        ws = words(text)
        if not self.least or len(ws) < self.least:
            return len(ws), [], set()
        ids = np.fromiter(map(self.vocab.get, ws, repeat(-1)), np.int64, len(ws))
        edge = np.diff(np.concatenate(([0], (ids >= 0).view(np.int8), [0])))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        long = ends - starts >= self.least
        spans, items = [], set()
        nxt, link, length, found, short, window = self.next, self.link, self.len, self.found, self.short, self.window
        for a, b in zip(starts[long].tolist(), ends[long].tolist()):
            s = n = 0
            for i, w in enumerate(ids[a:b].tolist(), a + 1):
                while s and w not in nxt[s]:
                    s = link[s]
                    n = length[s]
                s = nxt[s].get(w, 0)
                n = n + 1 if s else 0
                if n >= window:
                    spans.append((i - window, i))
                    items.update(found[s])
                for k, item in short[s]:
                    if k <= n:
                        spans.append((i - k, i))
                        items.add(item)
        return len(ws), spans, items


def blocks(items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS):
    """The items as automata of bounded size, one after another (rows are streamed to
    the driver partition by partition, so only one block is held)."""
    held, n = [], 0
    for k, text in items.select("item_id", F.col("text").cast("binary")).toLocalIterator():
        ws = words(bytes(text)) if text is not None else []
        if held and n + len(ws) > block_words:
            yield Automaton(held, window)
            held, n = [], 0
        held.append((k, ws))
        n += len(ws)
    yield Automaton(held, window)


def _merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def scan(docs: DataFrame, items: DataFrame, window: int = WINDOW, coverage: int = COVERAGE, block_words: int = BLOCK_WORDS, keep: list[str] | None = None, cut: bool = False) -> DataFrame:
    """Per row of ``docs`` the columns ``keep`` (default: doc_id) and n_words, n_hit,
    n_items, items_sha256, contaminated; with ``cut`` also ``rest``: the text without its
    hit words and the signs between them."""
    keep = keep or ["doc_id"]
    spark = docs.sparkSession
    body = docs.select(*keep, F.col("text").cast("binary").alias("_t"))
    kept = [body.schema[c] for c in keep]
    state = T.StructType([*kept, T.StructField("_t", T.BinaryType()), T.StructField("_s", T.ArrayType(T.LongType())), T.StructField("_i", T.ArrayType(T.StringType()))])
    result = [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("n_items", T.LongType()),
        T.StructField("items_sha256", T.StringType()),
        T.StructField("contaminated", T.BooleanType()),
    ]
    final = T.StructType([*kept, *result, *([T.StructField("rest", T.StringType())] if cut else [])])
    width = len(keep)

    def one_pass(sent, first: bool, last: bool):
        def run(batches):
            auto = Automaton.of(sent.value)
            for b in batches:
                texts = b.column(width).to_pylist()
                before = repeat(((), ())) if first else zip(b.column(width + 1).to_pylist(), b.column(width + 2).to_pylist())
                rows = []
                for t, (s0, i0) in zip(texts, before):
                    n, spans, found = auto.stream(t)
                    spans = _merged([*zip(s0[::2], s0[1::2]), *spans])
                    rows.append((n, spans, sorted({*i0, *(str(x) for x in found if x is not None)})))
                columns = [b.column(i) for i in range(width)]
                if not last:
                    columns += [b.column(width), pa.array([[x for ab in s for x in ab] for _, s, _ in rows], pa.list_(pa.int64())), pa.array([i for _, _, i in rows], pa.list_(pa.string()))]
                    yield pa.RecordBatch.from_arrays(columns, state.names)
                    continue
                hits = [sum(b - a for a, b in s) for _, s, _ in rows]
                columns += [
                    pa.array([n for n, _, _ in rows], pa.int64()),
                    pa.array(hits, pa.int64()),
                    pa.array([len(i) for _, _, i in rows], pa.int64()),
                    pa.array([hashlib.sha256(",".join(i).encode()).hexdigest() for _, _, i in rows], pa.string()),
                    pa.array([h > 0 and coverage * h >= n for h, (n, _, _) in zip(hits, rows)], pa.bool_()),
                ]
                if cut:
                    columns.append(pa.array([without(t, s) for t, (_, s, _) in zip(texts, rows)], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, final.names)

        return run

    # each block is one more pass over the rows, in the same tasks
    passes = [spark.sparkContext.broadcast(vars(a)) for a in blocks(items, window, block_words)]
    for i, sent in enumerate(passes):
        last = i == len(passes) - 1
        body = body.mapInArrow(one_pass(sent, i == 0, last), final if last else state)
    return body


def without(text: bytes | None, spans: list[list[int]]) -> str | None:
    """The text without the words in ``spans`` and the signs between them."""
    if text is None or not spans:
        return None if text is None else text.decode("utf-8", "replace")
    at = [m.span() for m in _RUN.finditer(text)]
    out, end = [], 0
    for a, b in spans:
        out.append(text[end : at[a][0]])
        end = at[b - 1][1]
    out.append(text[end:])
    return b"".join(out).decode("utf-8", "replace")


def clean(docs: DataFrame, items: DataFrame, whole: bool = True, **options) -> DataFrame:
    """``docs`` without contamination: contaminated rows go (``whole``), or only their hit
    spans are cut out of ``text``. Rows under the coverage limit stay as they are."""
    held = scan(packed(docs), items, keep=["_doc"], cut=not whole, **options)
    if whole:
        return held.filter("not contaminated").select("_doc.*")
    text = F.when(F.col("contaminated"), F.col("rest")).otherwise(F.col("_doc.text"))
    return held.select(*[text.alias(c) if c == "text" else F.col(f"_doc.`{c}`") for c in docs.columns])
