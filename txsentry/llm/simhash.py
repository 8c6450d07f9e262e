"""Near-duplicate documents: SimHash fingerprints and a binary-trie self-join.

Fingerprint: each shingle of ``shingle_words`` consecutive words (repeats included)
hashes to 64 bits (XXH64 of its UTF-8 bytes, seed 42); a bit is 1 if it is set in over
half of the hashes. A text of fewer words is one shingle; a text without words has
fingerprint 0, linked like any other.

Join: the distinct fingerprints form a binary trie over their bits, highest first. The
join walks pairs of trie nodes of the same depth together; a pair carries the number of
bits in which the two prefixes differ and is dropped as soon as that exceeds
``max_bits``. The upper levels are walked in Spark, two bits a step: a pair of nodes
that hold few fingerprints together becomes a piece of work, a heavier pair is replaced
by its children's pairs. Each piece is finished inside one task on sorted arrays, one
bit a step, with a bounded number of open node pairs. A piece reports which
fingerprints hang together (a spanning forest), not each pair, so a dense group of
copies costs rows in proportion to its members; no link is lost, as the components of
the forests are those of the links. Components are joined up in Spark.

Equal fingerprints are collapsed before the join (a group of exact copies is one trie
leaf).

Defined cases: null text has fingerprint 0; rows that share an id or a fingerprint are
in one component; a null id is no candidate for the smallest id (a component of null ids
only has a null component id); very long texts are hashed whole; an empty table gives an
empty result; extra columns are kept.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txsentry.llm.common import components, stage

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
STEP = 2  # bits of a step of the walk in Spark
PIECE = 4096  # a pair of nodes with at most so many fingerprints is one piece of work
OPEN = 1 << 18  # node pairs that a task expands at once
SLAB = 1 << 14  # hashes whose bits are counted at once


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of one text given as UTF-8 bytes."""
    words = (text or b"").lower().split()  # on bytes both touch ASCII only
    n = len(words)
    if n == 0:
        return 0
    k = min(shingle_words, n)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts[: n - k + 1].tolist(), ends[k - 1 :].tolist())), np.uint64, n - k + 1)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), SLAB):
        part = hashes[i : i + SLAB].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_hash, fp) for each row; fp is the fingerprint as a signed long."""

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, shingle_words) for t in b.column(2).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], ["doc_id", "text_hash", "fp"])

    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("text_hash", T.LongType()), T.StructField("fp", T.LongType())])
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


class _Forest:
    """Disjoint sets over positions 0..n-1."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.up[a], self.up[b]
            keep = a != b
            a, b = np.maximum(a[keep], b[keep]), np.minimum(a[keep], b[keep])
            if not len(a):
                return
            np.minimum.at(self.up, a, b)
            while True:
                higher = self.up[self.up]
                if np.array_equal(higher, self.up):
                    break
                self.up = higher


def join_subtries(values: np.ndarray, roots: list[tuple[int, int, int, int, int]], depth: int, max_bits: int) -> np.ndarray:
    """Walk pairs of subtries together. ``values``: sorted distinct fingerprints;
    ``roots``: pairs of ranges (lo, hi, lo2, hi2) of values with a common prefix of
    ``depth`` bits each, and the bits in which the two prefixes differ. Returns for each
    position the smallest position that it hangs together with."""
    forest = _Forest(len(values))
    stack = [(depth, np.array(roots, np.int64).reshape(-1, 5))]
    while stack:
        depth, pairs = stack.pop()
        if len(pairs) > OPEN:
            stack += [(depth, part) for part in np.array_split(pairs, -(-len(pairs) // OPEN))]
            continue
        lo, hi, lo2, hi2, d = pairs.T
        single = ((hi - lo) == 1) & ((hi2 - lo2) == 1)
        if single.any():
            a, b = lo[single], lo2[single]
            near = (a != b) & (np.bitwise_count(values[a] ^ values[b]) <= max_bits)
            forest.link(a[near], b[near])
            pairs = pairs[~single]
        if not len(pairs) or depth == 64:
            continue
        lo, hi, lo2, hi2, d = pairs.T
        bit = np.uint64(1 << (63 - depth))

        def middle(a, b):
            """The first position in each range [a, b) whose next bit is set."""
            low = values[a] & ~np.uint64((1 << (64 - depth)) - 1)
            return np.clip(np.searchsorted(values, low | bit), a, b)

        m, m2 = middle(lo, hi), middle(lo2, hi2)
        children = [(lo, m, lo2, m2, d), (m, hi, m2, hi2, d), (lo, m, m2, hi2, d + 1), (m, hi, lo2, m2, d + 1)]
        new = np.concatenate([np.stack(c, 1) for c in children])
        # a pair met in both orders (inside one subtrie) is kept in one
        ok = (new[:, 1] > new[:, 0]) & (new[:, 3] > new[:, 2]) & (new[:, 4] <= max_bits) & (new[:, 0] <= new[:, 2])
        if ok.any():
            stack.append((depth + 1, new[ok]))
    return forest.up


def _prefix(fp: str, depth: int):
    return F.shiftrightunsigned(F.col(fp), 64 - depth) if depth < 64 else F.col(fp)


def trie_links(fps: DataFrame, max_bits: int = MAX_BITS, piece: int = PIECE) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) whose components are those
    of all pairs that differ in at most ``max_bits`` bits."""
    spark = fps.sparkSession
    masks = [(m, m.bit_count()) for m in range(1 << STEP) if m.bit_count() <= max_bits]
    options = F.array(*[F.struct(F.lit(m).cast("long").alias("m"), F.lit(w).alias("w")) for m, w in masks])
    frontier, work, depth = None, None, 0
    while depth < 64:
        depth += STEP
        nodes = fps.groupBy(_prefix("fp", depth).alias("node")).agg(F.count(F.lit(1)).alias("n"))
        # the children's pairs of each open pair: a child of u, and the child of v that
        # differs from it in the bits of a mask
        if frontier is None:
            mine = nodes.select(F.col("node").alias("u"), F.col("n").alias("nu"), F.lit(0).cast("long").alias("pv"), F.lit(0).alias("d"))
        else:
            low = nodes.select(F.col("node").alias("u"), F.col("n").alias("nu"), F.shiftrightunsigned("node", STEP).alias("pu"))
            mine = low.join(frontier.select(F.col("u").alias("pu"), F.col("v").alias("pv"), "d"), "pu")
        met = mine.select("u", "nu", "pv", "d", F.explode(options).alias("o")).filter(F.col("d") + F.col("o.w") <= max_bits)
        last = F.col("u").bitwiseAND(F.lit((1 << STEP) - 1).cast("long")).bitwiseXOR(F.col("o.m"))
        met = met.select("u", "nu", F.shiftleft("pv", STEP).bitwiseOR(last).alias("v"), (F.col("d") + F.col("o.w")).alias("d")).filter("u <= v" if depth < 64 else "u <> v")
        met = stage(met.join(nodes.select(F.col("node").alias("v"), F.col("n").alias("nv")), "v"), f"trie-{depth}")
        heavy = (F.col("nu") + F.col("nv") > piece) if depth < 64 else F.lit(False)
        done = met.filter(~heavy).select("u", "v", "d", F.lit(depth).alias("depth"))
        work = done if work is None else work.unionByName(done)
        frontier = met.filter(heavy).select("u", "v", "d")
        if frontier.limit(1).count() == 0:
            break

    # a node's piece of work gets its own fingerprints and those of its partners
    pieces = stage(work, "trie-work")
    depths = [r[0] for r in pieces.select("depth").distinct().collect()]  # 16 at most
    parts = None
    for k in sorted(depths):
        here = pieces.filter(F.col("depth") == k)
        rows = fps.select("fp", _prefix("fp", k).alias("v")).join(here, "v").select("depth", "u", "v", "d", "fp")
        # a node with partners only is given its own fingerprints too
        alone = here.groupBy("u").agg(F.max((F.col("u") == F.col("v")).cast("int")).alias("self")).filter("self = 0")
        own = fps.select("fp", _prefix("fp", k).alias("u")).join(alone, "u").select(F.lit(k).alias("depth"), "u", F.col("u").alias("v"), F.lit(-1).alias("d"), "fp")
        both = rows.unionByName(own)
        parts = both if parts is None else parts.unionByName(both)
    if parts is None:
        return spark.createDataFrame([], "a long, b long")

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        depth, u = int(pdf["depth"].iloc[0]), int(pdf["u"].iloc[0])
        fp = pdf["fp"].to_numpy().view(np.uint64)
        values, at = np.unique(fp, return_inverse=True)
        node = np.zeros(len(values), np.int64)
        node[at] = pdf["v"].to_numpy()
        # values of a node are neighbours in the order: its range is [lo, hi)
        spans = {}
        cuts = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
        for lo, hi in zip(cuts, [*cuts[1:], len(values)]):
            spans[int(node[lo])] = (int(lo), int(hi))
        lo, hi = spans[u]
        wanted = pdf[["v", "d"]].drop_duplicates()
        roots = []
        for v, d in zip(wanted["v"], wanted["d"]):
            if d >= 0:
                a, b = spans[int(v)]
                roots.append((lo, hi, a, b, int(d)) if lo <= a else (a, b, lo, hi, int(d)))
        up = join_subtries(values, roots, depth, max_bits)
        linked = np.flatnonzero(up != np.arange(len(values)))
        out = values.view(np.int64)
        return pd.DataFrame({"a": out[linked], "b": out[up[linked]]})

    return parts.groupBy("depth", "u").applyInPandas(finish, "a long, b long")


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, fp, root (the component's name) and
    component_id (the smallest doc_id reachable over links, its own included)."""
    marked = stage(fingerprints(docs, shingle_words), "simhash")
    distinct = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = components(trie_links(distinct.select("fp"), max_bits), "simhash-cc")
    joined = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    joined = stage(joined, "simhash-roots")
    least = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    ids = joined.join(least, "root").select(F.col("fp").alias("_fp"), "root", "component_id")
    return marked.join(ids, marked["fp"] == ids["_fp"]).select("doc_id", "text_hash", "fp", "root", "component_id")


def keep_first(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id (rows without an
    id after all others, equal ids by text hash; of equal rows any one)."""
    found = near_duplicates(docs, shingle_words, max_bits)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("r"))
    first = first.select(F.col("r.doc_id").alias("_id"), F.col("r.text_hash").alias("_h"))
    out = docs.withColumn("_text", F.xxhash64("text")).join(first, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_h")))
    alike = Window.partitionBy("_id", "_h").orderBy(F.lit(0))
    return out.withColumn("_rn", F.row_number().over(alike)).filter("_rn = 1").select(*docs.columns)
