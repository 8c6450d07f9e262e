"""BPE encoding and decoding in batched numpy merge rounds.

Texts are normalised and split into words as the tokenizer file says. The distinct new
words of a batch are laid out as one flat array of symbols. A round finds the rank of each
neighbouring pair by binary search over the sorted pair keys, takes the lowest rank of each
word, merges all its places (of overlapping ones every second, from the left) and closes
the gaps; only pairs beside a merge are searched again, and words without a pair left leave
the array. This gives the same result as one merge at a time, as no rule that uses a symbol
ranks before the rule that makes it (checked on loading).

Words of more than ``LONG`` symbols would need as many rounds as they have different pairs,
so each is merged alone, lowest rank first, by a heap over a linked list.

A task keeps the tokens of up to ``KEPT`` distinct words. Tokens of a batch of texts are
gathered from that table by position. Decoding gathers the tokens' texts by id and joins
them with a space, as the file has no decoder.

Defined cases: a null text has no tokens, like an empty one, and decodes to the empty text;
strings of special tokens in a text become their ids; very long texts and words are encoded
whole; repeated rows get equal results; an empty table gives an empty result; the columns
named in ``keep`` pass unchanged, others are not looked at. Classes and cases of code points
are those of Python's character tables; letters that Unicode gained later count as signs.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LONG = 256  # symbols from which a word is merged alone
KEPT = 1 << 20  # distinct words whose tokens a task keeps
SLICE = 1 << 21  # characters of text that are encoded at once
NONE = np.int64(1) << 40  # the rank of a pair without a rule


def byte_signs() -> list[str]:
    """The printable sign that stands for each byte: itself where it is printable and no
    blank, else the next unused one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


def in_class(kinds: str, *others: str) -> str:
    """The inside of a character class: all code points whose general category begins with
    one of ``kinds``, as ranges, and ``others``."""
    codes = np.array([c for c in range(0x110000) if unicodedata.category(chr(c))[0] in kinds])
    cut = np.flatnonzero(np.diff(codes) > 1)
    ranges = zip(codes[np.append(0, cut + 1)].tolist(), codes[np.append(cut, len(codes) - 1)].tolist())
    return "".join([*(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges), *others])


def load(path: str) -> dict:
    """A tokenizer file as plain arrays and texts (their size is that of its vocabulary)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, steps = spec["model"], (spec["normalizer"] or {}).get("normalizers", [])
    split = spec["pre_tokenizer"]["pretokenizers"][0]
    plain = [s["type"] for s in steps if s["type"] != "Replace"] == ["NFC", "Lowercase"]
    # white space is dropped by the split, so replacing it by a blank changes nothing
    plain &= all(s["pattern"] == {"Regex": r"\s+"} and s["content"] == " " for s in steps if s["type"] == "Replace")
    plain &= model["type"] == "BPE" and not any(model[k] for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"))
    plain &= split["type"] == "Split" and split["behavior"] == "Removed" and split["invert"] and spec["decoder"] is None and spec["post_processor"] is None
    if not plain:
        raise ValueError(f"{path}: not a byte-level BPE file with NFC, lower case and word ends")
    vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
    rules = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
    left, right = (np.array([vocab[x[k]] for x in rules], np.int64) for k in (0, 1))
    made = np.array([vocab[a + b] for a, b in rules], np.int64)
    last = np.full(max(vocab.values()) + 1, -1, np.int64)
    np.maximum.at(last, made, np.arange(len(rules)))
    if (np.maximum(last[left], last[right]) > np.arange(len(rules))).any():
        raise ValueError(f"{path}: a rule ranks before the one that makes its symbol")
    pattern = split["pattern"]["Regex"]
    for name, inside in ((r"\p{L}", in_class("L")), (r"\p{N}", in_class("N")), (r"\s", in_class("Z", r"\t-\r\x85"))):
        pattern = pattern.replace(name, inside)  # the file has them inside brackets
    keys = left << 32 | right
    order = np.argsort(keys)
    special = {x["content"]: x["id"] for x in spec["added_tokens"]}
    tokens = {i: t for t, i in [*vocab.items(), *special.items()]}
    signs = byte_signs()
    return {
        "keys": keys[order],
        "rank": order.astype(np.int64),
        "made": made[order],
        "inner": np.array([vocab[s] for s in signs], np.int64),
        "final": np.array([vocab[s + end] for s in signs], np.int64),
        "tokens": [tokens.get(i) for i in range(max(tokens) + 1)],
        "special": special,
        "pattern": pattern,
    }


class Encoder:
    def __init__(self, tables: dict):
        self.t = tables
        self.find = re.compile(tables["pattern"]).findall
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(tables["special"], key=len, reverse=True))) + ")") if tables["special"] else None
        self._forget()

    def _forget(self) -> None:
        self.place = {w: i for i, w in enumerate(self.t["special"])}
        self.flat = np.array(list(self.t["special"].values()), np.int32)
        self.count = np.ones(len(self.flat), np.int64)
        self.begin = np.arange(len(self.flat), dtype=np.int64)

    def words(self, text: str | None) -> list[str]:
        """The words of a text; a special token is one word that no other can equal."""
        if not text:
            return []
        if self.special and self.special.search(text):
            parts = self.special.split(text)
            return [w for i, p in enumerate(parts) for w in ([p] if i % 2 else self._split(p))]
        return self._split(text)

    def _split(self, text: str) -> list[str]:
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            # letter by letter: no special case for a sigma that ends a word
            text = text.replace("Σ", "σ")
        return self.find(text.lower())

    def _search(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE: no rule) and product of each pair."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.t["keys"], keys), len(self.t["keys"]) - 1)
        known = self.t["keys"][at] == keys
        return np.where(known, self.t["rank"][at], NONE), self.t["made"][at]

    def _symbols(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        size = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbol = self.t["inner"][raw]
        ends = np.cumsum(size) - 1
        symbol[ends] = self.t["final"][raw[ends]]
        return symbol, size

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all words, one after another, and their number per word."""
        symbol, size = self._symbols(words)
        word = np.repeat(np.arange(len(words)), size)
        done_symbol, done_word = [], []
        alone = size > LONG
        if alone.any():
            for w in np.flatnonzero(alone).tolist():
                out = self._merge_long(symbol[word == w])
                done_symbol.append(out)
                done_word.append(np.full(len(out), w))
            stay = ~alone[word]
            symbol, word = symbol[stay], word[stay]

        def pairs(at):
            rank, made = self._search(symbol[at], symbol[at + 1])
            return np.where(word[at] == word[at + 1], rank, NONE), made

        # rank[i], made[i]: of the pair that begins at symbol i
        rank, made = np.full(len(symbol), NONE), np.zeros(len(symbol), np.int64)
        if len(symbol) > 1:
            rank[:-1], made[:-1] = pairs(np.arange(len(symbol) - 1))
        while len(symbol):
            start = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            length = np.diff(np.append(start, len(word)))
            lowest = np.minimum.reduceat(rank, start)
            over = np.repeat(lowest == NONE, length)
            if over.any():
                done_symbol.append(symbol[over])
                done_word.append(word[over])
                symbol, word, rank, made = symbol[~over], word[~over], rank[~over], made[~over]
                length, lowest = length[lowest != NONE], lowest[lowest != NONE]
                if not len(symbol):
                    break
            hit = rank == np.repeat(lowest, length)
            # overlapping places (a a a): every second from the left
            place = np.arange(len(hit))
            begins = hit & ~np.concatenate(([False], hit[:-1]))
            hit &= (place - np.maximum.accumulate(np.where(begins, place, 0))) % 2 == 0
            symbol[hit] = made[hit]
            stay = ~np.concatenate(([False], hit[:-1]))
            at = np.flatnonzero(hit[stay])
            symbol, word, rank, made = symbol[stay], word[stay], rank[stay], made[stay]
            for beside in (at[at < len(symbol) - 1], at[at > 0] - 1):
                rank[beside], made[beside] = pairs(beside)
            rank[-1] = NONE
        symbol, word = np.concatenate([*done_symbol, []]), np.concatenate([*done_word, []]).astype(np.int64)
        order = np.argsort(word, kind="stable")
        return symbol[order].astype(np.int32), np.bincount(word, minlength=len(words))

    def _merge_long(self, symbol: np.ndarray) -> np.ndarray:
        """One word, pair by pair: lowest rank first, then from the left."""
        rank, made = (x.tolist() for x in self._search(symbol[:-1], symbol[1:]))
        n, sym = len(symbol), symbol.tolist()
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(r, i, sym[i], sym[i + 1], m) for i, (r, m) in enumerate(zip(rank, made)) if r != NONE]
        heapq.heapify(heap)
        rules = {}  # pairs already searched

        def push(i):
            pair = (sym[i], sym[after[i]])
            if pair not in rules:
                r, m = self._search(np.array(pair[:1], np.int64), np.array(pair[1:], np.int64))
                rules[pair] = (int(r[0]), int(m[0]))
            r, m = rules[pair]
            if r != NONE:
                heapq.heappush(heap, (r, i, *pair, m))

        while heap:
            _, i, a, b, m = heapq.heappop(heap)
            j = after[i]
            if sym[i] != a or j < 0 or sym[j] != b:
                continue
            sym[i], sym[j] = m, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
                push(i)
            if before[i] >= 0:
                push(before[i])
        return np.array([s for s in sym if s >= 0], np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and their number per text."""
        words = [self.words(t) for t in texts]
        if len(self.place) > KEPT:
            self._forget()
        new = list({*chain.from_iterable(words)} - self.place.keys())
        if new:
            flat, count = self.merge([w.encode() for w in new])
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            self.begin = np.concatenate((self.begin, len(self.flat) + np.cumsum(count) - count))
            self.flat, self.count = np.concatenate((self.flat, flat)), np.concatenate((self.count, count))
        per_text = np.fromiter(map(len, words), np.int64, len(words))
        which = np.fromiter(map(self.place.__getitem__, chain.from_iterable(words)), np.int64, per_text.sum())
        count = self.count[which]
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        # position in the table: that of the word's first token, and on from there
        ids = self.flat[np.arange(total) + np.repeat(self.begin[which] - (ends - count), count)]
        sums = np.concatenate(([0], ends))
        edge = np.concatenate(([0], np.cumsum(per_text)))
        return ids, sums[edge[1:]] - sums[edge[:-1]]


def _slices(sizes: list[int], most: int):
    """Ranges of rows that hold at most so much together, or one row."""
    begin, held = 0, 0
    for i, n in enumerate(sizes):
        if i > begin and held + n > most:
            yield begin, i
            begin, held = i, 0
        held += n
    if begin < len(sizes):
        yield begin, len(sizes)


def encode(docs: DataFrame, path: str, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """The columns ``keep`` (default: doc_id) and ``ids``: the token ids of the text, without
    added special tokens. ``path``: the tokenizer file, read by the driver."""
    keep = keep or ["doc_id"]
    sent = docs.sparkSession.sparkContext.broadcast(load(path))
    body = docs.select(*keep, F.col(text).alias("_t"))
    width = len(keep)
    schema = T.StructType([*[body.schema[c] for c in keep], T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def run(batches):
        coder = Encoder(sent.value)
        for b in batches:
            texts = b.column(width).to_pylist()
            for lo, hi in _slices([len(t or "") for t in texts], SLICE):
                ids, count = coder.encode(texts[lo:hi])
                edges = pa.array(np.concatenate(([0], np.cumsum(count))).astype(np.int32))
                lists = pa.ListArray.from_arrays(edges, pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([*[b.column(i).slice(lo, hi - lo) for i in range(width)], lists], schema.names)

    return body.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """All columns and ``decoded``: the text of the ids. An id that the file does not know is
    left out; null ids decode to the empty text."""
    sent = encoded.sparkSession.sparkContext.broadcast(load(path)["tokens"])
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])
    at, width = encoded.columns.index(ids), len(encoded.columns)

    def run(batches):
        tokens = pa.array(sent.value, pa.string())
        for b in batches:
            lists = pc.fill_null(b.column(at).cast(pa.list_(pa.int32())), pa.scalar([], pa.list_(pa.int32())))
            for lo, hi in _slices(pc.list_value_length(lists).to_pylist(), SLICE):
                part = lists.slice(lo, hi - lo)
                flat = part.flatten()
                known = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(tokens)))
                texts = tokens.take(pc.if_else(known, flat, None))
                if texts.null_count:
                    owner = pc.list_parent_indices(part).filter(pc.is_valid(texts))
                    texts = texts.drop_null()
                    size = np.bincount(owner.to_numpy(), minlength=hi - lo)
                else:
                    size = pc.list_value_length(part).to_numpy()
                edges = pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32))
                joined = pc.binary_join(pa.ListArray.from_arrays(edges, texts), " ")
                yield pa.RecordBatch.from_arrays([*[b.column(i).slice(lo, hi - lo) for i in range(width)], joined], schema.names)

    return encoded.mapInArrow(run, schema)
