"""Spelling variants: words one edit apart, by dense prefix-suffix tiling.

Two words differ by exactly one inserted, deleted or replaced code point if their common
prefix and suffix together reach the longer length minus one. Words are laid out as
padded code-point matrices and blocks of them are compared pair by pair: prefix lengths
grow column by column from the left, suffix lengths from the right.

Blocks come from the place of the edit. For words of length ``l`` and ``l`` or ``l + 1``
it is one of ``l + 1`` places; they are cut into ranges, and an edit inside a range leaves
all code points before and after it alone. So words that agree on these meet in a block,
and only the free part between is compared. A pair counts in the range that holds the end
of its common prefix, hence once. A block of more than ``tile`` words (or ``AREA`` cells)
has its range halved, its words going to both halves, until it fits; a range of one place
leaves one or two free code points, so that no block outgrows the alphabet. No candidate is
capped.

Blocks of like size are stacked and compared together; a task sees whole blocks of bounded
size, and gives one row per word and block (its near words' number and the best of them),
not the pairs.

Defined cases: null and empty texts have no words; a null id counts as the empty text in
the deletion rule; rows that share an id are separate documents; very long texts are read
whole, very long words compared in ranges; equal counts are broken by code-point order; an
empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txsentry.llm.common import stage

MIN_LENGTH = 7  # code points
MIN_COUNT = 2
DROP_ONE_IN = 31
FORM_RATIO = 10  # a form occurs at least so many times as often as its word
RANGES = 3  # first ranges of edit places per length
TILE = 1024  # words of a block that are compared at once
AREA = 1 << 22  # cells (words x free code points) of such a block
CELLS = 1 << 20  # pairs compared in one numpy step
FLUSH = 200_000  # distinct words that a task counts before it hands them on

# Latin-1 code points that make up words, A-Z lower-cased; all else parts words
_LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0xC0 else 0x20 for c in range(256))


def runs(text: str | None) -> list[bytes]:
    """The lower-cased runs of a text, as UTF-8."""
    return (text or "").encode("latin-1", "replace").translate(_LETTERS).decode("latin-1").encode().split()


def without_one(word: bytes, at: int) -> bytes:
    s = word.decode()
    at %= len(s)
    return (s[:at] + s[at + 1 :]).encode()


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, drop_one_in: int = DROP_ONE_IN) -> DataFrame:
    """(word, n): the words of all texts after the deletion rule, with their counts."""

    def count(batches):
        seen: Counter = Counter()

        def rows():
            out = [(w.decode(), n) for w, n in seen.items() if n]
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in out], pa.string()), pa.array([n for _, n in out], pa.int64())], ["word", "n"])

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = [w for w in runs(text) if len(w) >= min_length]
                if not words:
                    continue
                seen.update(words)
                hashes = np.fromiter(map(zlib.crc32, words, repeat(zlib.crc32(f"{doc_id}:".encode()))), np.uint32, len(words))
                for i in np.flatnonzero(hashes % drop_one_in == 0).tolist():
                    seen[words[i]] -= 1
                    seen[without_one(words[i], int(hashes[i]))] += 1
                if len(seen) >= FLUSH:
                    yield rows()
        if seen:
            yield rows()

    parts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text").mapInArrow(count, "word string, n long")
    total = parts.filter(F.length("word") >= min_length).groupBy("word").agg(F.sum("n").alias("n"))
    return total.filter(F.col("n") >= min_count)


def _compare(free: list[bytes], size: np.ndarray, longer: np.ndarray, wide: np.ndarray, start: np.ndarray, members: np.ndarray):
    """Compare the words of each block with each other. ``free``: free parts (Latin-1) of all
    rows; ``size``: their lengths; ``longer``: whether a row's word has the greater length
    of its block; per block: ``wide`` (places of its range), ``start`` and ``members``
    (its rows). Gives per row the number of near rows and the position in its block of the
    first of them."""
    number = np.zeros(len(free), np.int64)
    first = np.zeros(len(free), np.int64)
    if not len(start):
        return number, first
    flat = np.frombuffer(b"".join(free), np.uint8)
    begin = np.cumsum(size) - size
    columns = np.maximum.reduceat(size, start)
    # blocks of like shape: both sides rounded up to powers of two
    side = 1 << np.ceil(np.log2(members)).astype(np.int64)
    depth = 1 << np.ceil(np.log2(np.maximum(columns, 1))).astype(np.int64)
    shapes, which = np.unique(np.stack([side, depth], 1), axis=0, return_inverse=True)
    for k, (s, d) in enumerate(shapes.tolist()):
        of = np.flatnonzero(which.ravel() == k)
        step = max(1, CELLS // (s * max(s, d)))
        for blocks in (of[i : i + step] for i in range(0, len(of), step)):
            place = np.arange(s)
            there = place < members[blocks, None]
            row = np.where(there, start[blocks, None] + place, 0)
            length = np.where(there, size[row], -9)
            left, right = np.zeros((2, len(blocks), s, d), np.uint8)
            col = np.arange(d)
            inside = col < length[..., None]
            at = begin[row][..., None] + col
            left[inside] = flat[at[inside]]
            shifted = col - (d - length[..., None])  # the same part, aligned to the right
            inside = (shifted >= 0) & there[..., None]
            right[inside] = flat[(begin[row][..., None] + shifted)[inside]]
            kind = np.uint8 if d < 128 else np.int32
            common = []
            for m, order in ((left, range(d)), (right, range(d - 1, -1, -1))):
                alive = np.ones((len(blocks), s, s), bool)
                run = np.zeros((len(blocks), s, s), kind)
                for c in order:
                    alive &= m[:, :, None, c] == m[:, None, :, c]
                    run += alive
                common.append(run)
            prefix, suffix = common
            longest = np.maximum(length[:, :, None], length[:, None, :])
            near = prefix.astype(np.int64) + suffix >= longest - 1
            near &= np.abs(length[:, :, None] - length[:, None, :]) <= 1
            grown = longer[row]
            near &= ~(grown[:, :, None] & grown[:, None, :])
            near &= prefix < wide[blocks, None, None]
            near &= there[:, :, None] & there[:, None, :]
            near[:, place, place] = False
            number[row[there]] = near.sum(2)[there]
            first[row[there]] = near.argmax(2)[there]
    return number, first


def near_words(words: DataFrame, tile: int = TILE, ranges: int = RANGES) -> DataFrame:
    """For ``words`` (word, n; distinct, code points below U+0100): a row (word, n_near,
    best_n, best) for each word and block in which it has near words; best is the near word
    of largest n there, the smallest in code-point order among equals."""
    shortest = words.agg(F.min(F.length("word"))).first()[0] or 0
    length = F.length("word")
    cut = [F.floor((F.col("l") + 1) * k / ranges).cast("int") for k in range(ranges + 1)]
    # a word of length L meets words of its length and L + 1 (l = L), and of L - 1 (l = L - 1)
    spread = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("l")).filter(F.col("l") >= shortest)
    spread = spread.select("word", "n", "l", F.explode(F.array(*[F.struct(a.alias("a"), b.alias("b")) for a, b in zip(cut, cut[1:])])).alias("r"))
    open_rows = spread.select("word", "n", "l", "r.a", "r.b").filter("a < b")
    after = F.greatest(F.col("l") - F.col("b"), F.lit(0))

    def keyed(rows: DataFrame) -> DataFrame:
        fixed = F.xxhash64("l", "a", "b", F.expr("left(word, a)"), F.when(after > 0, F.right("word", after)).otherwise(""))
        return rows.withColumn("block", fixed)

    fit = None
    while True:
        rows = keyed(open_rows)
        large = rows.groupBy("block").agg(F.count(F.lit(1)).alias("members"), F.max(F.col("b") - F.col("a")).alias("places"))
        too_large = (F.col("members") > tile) | (F.col("members") * F.col("places") > AREA)
        large = stage(large.filter(too_large & (F.col("places") > 1)).select("block"), "spelling-large")
        if large.limit(1).count() == 0:
            fit = rows if fit is None else fit.unionByName(rows)
            break
        small = rows.join(large, "block", "left_anti").select(rows.columns)
        fit = small if fit is None else fit.unionByName(small)
        middle = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
        halves = F.explode(F.array(F.struct(F.col("a").alias("a"), middle.alias("b")), F.struct(middle.alias("a"), F.col("b").alias("b"))))
        open_rows = stage(rows.join(large, "block", "left_semi").select("word", "n", "l", halves.alias("r")).select("word", "n", "l", "r.a", "r.b"), "spelling-open")

    free = F.expr("substring(word, a + 1, length(word) - a - greatest(l - b, 0))")
    ordered = fit.select("block", "n", "word", free.alias("free"), (F.length("word") > F.col("l")).alias("longer"), (F.col("b") - F.col("a")).alias("wide"))
    ordered = ordered.repartition("block").sortWithinPartitions("block", F.desc("n"), "word")

    def compare(table: pa.Table):
        block = table["block"].to_numpy()
        start = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        members = np.diff(np.concatenate((start, [len(block)])))
        several = members > 1
        parts = [x.encode("latin-1") for x in table["free"].to_pylist()]
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        wide = table["wide"].to_numpy()[start]
        number, first = _compare(parts, size, table["longer"].to_numpy(), wide[several], start[several], members[several])
        at = np.flatnonzero(number)
        best = np.repeat(start, members)[at] + first[at]
        names = ["word", "n_near", "best_n", "best"]
        columns = [table["word"].take(at), pa.array(number[at]), table["n"].take(best), table["word"].take(best)]
        return pa.Table.from_arrays(columns, names).combine_chunks().to_batches()

    def run(batches):
        held = None  # the block that the last batch ended in
        for b in batches:
            table = pa.Table.from_batches([b])
            table = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            block = table["block"].to_numpy()
            last = len(block) and int(np.searchsorted(block, block[-1]))
            held = table.slice(last)
            if last:
                yield from compare(table.slice(0, last).combine_chunks())
        if held is not None and held.num_rows:
            yield from compare(held.combine_chunks())

    return ordered.mapInArrow(run, "word string, n_near long, best_n long, best string")


def variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, drop_one_in: int = DROP_ONE_IN, ratio: int = FORM_RATIO, tile: int = TILE) -> DataFrame:
    """Per distinct word: word, form, root, n, n_near, form_n (see the module's docstring).
    form: its near word of largest n, if that is at least ``ratio`` times its own; root:
    where following forms ends."""
    words = stage(word_counts(docs, min_length, min_count, drop_one_in), "spelling-words")
    near = near_words(words, tile)
    # words and their blocks' rows meet in one aggregate
    best = F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))
    parts = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("struct<less:bigint,word:string>").alias("best"))
    parts = parts.unionByName(near.select("word", F.lit(None).cast("long").alias("n"), "n_near", best.alias("best")))
    found = parts.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    has = -F.col("best.less") >= ratio * F.col("n")
    found = stage(found.select("word", "n", "n_near", F.when(has, F.col("best.word")).alias("form"), F.when(has, -F.col("best.less")).alias("form_n")), "spelling-forms")
    # a form occurs more often than its word, so chains end; each round doubles the reach
    hops = stage(found.filter("form is not null").select("word", F.col("form").alias("root")), "spelling-hops")
    while True:
        on = hops.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        further = hops.join(on, hops["root"] == on["_w"], "left").select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved"))
        further = stage(further, "spelling-hops")
        hops = further.select("word", "root")
        if further.filter("moved").limit(1).count() == 0:
            break
    ends = hops.select(F.col("word").alias("_w"), "root")
    out = found.join(ends, found["word"] == ends["_w"], "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
