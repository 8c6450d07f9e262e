"""Ranked lexical search over a K2-treap of the term-document grid.

The index is a table of shards; a shard holds a range of documents whose texts have about
``SHARD_TERMS`` terms together. Its grid has a row for each distinct term (the most widespread
first) and a column for each document. A cell that is not empty holds the impact of the
term in the document, the part of the score that does not depend on the number of
documents with the term. The grid is stored as a quadtree in breadth-first order: for each
node the set of its non-empty quarters (four bits) and by how much its greatest impact
falls short of its parent's. Empty quarters take no space, and positions of children
follow from counts of set bits.

A search takes the row paths of an item's terms together down the tree. The unit of work is
a range of documents with one node per term; its bound is the sum of the terms' weights
times the nodes' greatest impacts. Ranges are taken best first, in batches, and halved;
ranges of one document have their score. It ends when no open range reaches the score of
the item's last place. Shards of one task share these places, so that later shards are cut
off early; what the tasks found is merged by rank in two steps.

Items are a stated query set, taken in blocks of at most ``BLOCK_TERMS`` terms, each one a
broadcast of bounded size and a pass over the index.

Defined cases: null and empty texts have no terms, count for nothing and are never found;
an item without terms has no rows; each row of ``items`` is an item, also if ids repeat;
rows that share an id are separate documents; of equal scores the smaller id comes first,
null ids last; a text of more than ``SHARD_TERMS`` terms is a shard of its own; empty tables
give an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txsentry.llm.common import shuffle_width, stage
from txsentry.llm.decontaminate import words

PLACES = 50
SHARD_TERMS = 1 << 20
SHARD_DOCS = 1 << 14
BLOCK_TERMS = 200_000
BATCH = 128  # ranges that are opened at once
_BITS = np.array([m.bit_count() for m in range(16)], np.int32)


def _spread(x: np.ndarray) -> np.ndarray:
    """Bits moved to the even places."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | x << np.uint64(shift)) & np.uint64(mask)
    return x


def impact(tf: np.ndarray, terms: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The part of a term's score that its document gives (terms: the document's length)."""
    m = 50 + 50 * terms * n_docs // n_terms
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def build_tree(row: np.ndarray, col: np.ndarray, value: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Depth, quarters (a byte a node, lowest level left out) and shortfalls of the treap over
    the points (row, col), in breadth-first order. Quarter 2 * r + c is row half r, column half c."""
    code = _spread(row) << np.uint64(1) | _spread(col)
    order = np.argsort(code)
    code, top = code[order], value[order]
    depth = int(max(row.max(), col.max())).bit_length()
    quarters, short = [], []
    for _ in range(depth):
        up = code >> np.uint64(2)
        start = np.flatnonzero(np.concatenate(([True], up[1:] != up[:-1])))
        above = np.maximum.reduceat(top, start)
        quarters.append(np.bitwise_or.reduceat(np.uint8(1) << (code & np.uint64(3)).astype(np.uint8), start))
        short.append(np.repeat(above, np.diff(np.append(start, len(code)))) - top)
        code, top = up[start], above
    short.append(top)  # the root's own greatest value
    return depth, np.concatenate([*quarters[::-1], np.empty(0, np.uint8)]), np.concatenate(short[::-1]).astype(np.int32)


class Treap:
    """A tree as stored, made ready for descent. Node 0 is no node, node 1 the root."""

    def __init__(self, depth: int, quarters: np.ndarray, short: np.ndarray):
        self.depth = depth
        kids = _BITS[quarters]
        leaves = len(short) - len(quarters)
        self.quarters = np.concatenate((np.zeros(1, np.uint8), quarters, np.zeros(leaves, np.uint8)))
        self.first = np.zeros(len(short) + 1, np.int32)
        self.first[1 : len(quarters) + 1] = 2 + np.cumsum(kids, dtype=np.int32) - kids
        self.top = np.zeros(len(short) + 1, np.int32)
        np.negative(short, out=self.top[1:])
        self.top[1] = short[0]
        lo, hi = 1, 2
        for _ in range(depth):  # greatest values from the root down
            end = hi + int(kids[lo - 1 : hi - 1].sum())
            self.top[hi:end] += np.repeat(self.top[lo:hi], kids[lo - 1 : hi - 1])
            lo, hi = hi, end

    def child(self, node: np.ndarray, quarter: np.ndarray) -> np.ndarray:
        mask = self.quarters[node]
        there = mask >> quarter & 1
        return np.where(there, self.first[node] + _BITS[mask & ((1 << quarter) - 1)], 0)

    def best(self, rows: np.ndarray, weights: np.ndarray, places: int, least: int):
        """Columns and scores of all that can be among the ``places`` best, given that only
        scores of ``least`` or more count: (columns, scores), in no order."""
        node = np.ones((1, len(rows)), np.int64)
        found_col, found_score = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        bound = np.array([(weights * int(self.top[1])).sum()])
        level, col = np.array([self.depth]), np.array([0])
        bar, top = max(least, 1), np.empty(0, np.int64)
        if self.depth == 0:  # one term, one document
            return col[bound >= bar], bound[bound >= bar]
        while len(bound):
            ahead = bound >= bar
            if not ahead.all():
                bound, level, col, node = bound[ahead], level[ahead], col[ahead], node[ahead]
                if not len(bound):
                    break
            # best ranges first
            take = np.argpartition(-bound, BATCH - 1)[:BATCH] if len(bound) > BATCH else np.arange(len(bound))
            keep = np.ones(len(bound), bool)
            keep[take] = False
            at = level[take] - 1
            half = rows[None, :] >> at[:, None] & 1
            kids = np.concatenate([self.child(node[take], 2 * half + c) for c in (0, 1)])
            cols = np.concatenate([col[take], col[take] | 1 << at])
            at = np.concatenate([at, at])
            new = self.top[kids] @ weights
            ok = new >= bar
            done = ok & (at == 0)
            if done.any():
                found_col.append(cols[done])
                found_score.append(new[done])
                top = np.concatenate((top, new[done]))
                if len(top) >= places:
                    top = -np.partition(-top, places - 1)[:places]
                    bar = max(bar, int(top.min()))
            ok &= at > 0
            bound, level, col = (np.concatenate((x[keep], y[ok])) for x, y in ((bound, new), (level, at), (col, cols)))
            node = np.concatenate((node[keep], kids[ok]))
        cols, scores = np.concatenate(found_col), np.concatenate(found_score)
        return cols[scores >= bar], scores[scores >= bar]


def build_index(docs: DataFrame, shard_terms: int = SHARD_TERMS, shard_docs: int = SHARD_DOCS) -> tuple[DataFrame, int, int]:
    """The index of ``docs`` (doc_id, text) as a table of shards, the number of documents with
    a term and the number of their terms. Columns: docs (ids by column), terms (distinct terms
    by row, joined by blanks), df (documents per row), depth, quarters, short; texts and tree
    compressed, as a task reads several shards at once but needs one."""

    def sizes(batches):
        for b in batches:
            n = [len(words(t)) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([sum(x > 0 for x in n)], pa.int64()), pa.array([sum(n)], pa.int64())], ["docs", "terms"])

    counts = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(sizes, "docs long, terms long")
    n_docs, n_terms = counts.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).first()
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType.fromDDL("terms binary, df binary, depth int, quarters binary, short binary")
    schema = T.StructType([T.StructField("docs", T.ArrayType(kind)), *schema.fields])

    def squeeze(data: bytes) -> bytes:
        return zstandard.ZstdCompressor(level=1).compress(data)

    def shard(ids, doc_terms, names):
        size = np.fromiter(map(len, doc_terms), np.int64, len(doc_terms))
        cell, tf = np.unique(np.repeat(np.arange(len(ids)), size) << 32 | np.concatenate(doc_terms), return_counts=True)
        col, term = cell >> 32, cell & 0xFFFFFFFF
        df = np.bincount(term, minlength=len(names))
        order = np.argsort(-df, kind="stable")  # widespread terms share the tree's corner
        row = np.empty(len(names), np.int64)
        row[order] = np.arange(len(names))
        depth, quarters, short = build_tree(row[term], col, impact(tf, size[col], n_docs, n_terms))
        in_order = b" ".join([names[i] for i in order.tolist()])
        values = [squeeze(in_order), df[order].astype(np.int32).tobytes(), depth, squeeze(quarters.tobytes()), squeeze(short.tobytes())]
        return pa.RecordBatch.from_arrays([pa.array([ids.to_pylist()], pa.list_(ids.type)), *[pa.array([v]) if not isinstance(v, int) else pa.array([v], pa.int32()) for v in values]], schema.names)

    def run(batches):
        ids, held, total, number = [], [], 0, defaultdict(count().__next__)
        for b in batches:
            for i, text in enumerate(b.column(1).to_pylist()):
                ws = words(text)
                if not ws:
                    continue
                if held and (total + len(ws) > shard_terms or len(held) >= shard_docs):
                    yield shard(pa.concat_arrays(ids), held, list(number))
                    ids, held, total, number = [], [], 0, defaultdict(count().__next__)
                held.append(np.fromiter(map(number.__getitem__, ws), np.int64, len(ws)))
                ids.append(b.column(0).slice(i, 1))
                total += len(ws)
        if held:
            yield shard(pa.concat_arrays(ids), held, list(number))

    index = docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)
    return stage(index, "lexical-index"), n_docs, n_terms


def _blocks(items: DataFrame, most: int):
    """(first number, [(item_id, distinct terms)]): items in blocks of at most so many terms,
    streamed to the driver partition by partition."""
    held, size, first = [], 0, 0
    rows = items.select("item_id", F.col("text").cast("binary")).toLocalIterator()
    for number, (item_id, text) in enumerate(rows):
        terms = sorted({*words(bytes(text) if text is not None else None)})
        if held and size + len(terms) > most:
            yield first, held
            held, size, first = [], 0, number
        held.append((item_id, terms))
        size += len(terms)
    if held:
        yield first, held


def _search(index: DataFrame, block: list, n_docs: int, places: int) -> DataFrame:
    """(item, doc_id, score): for each item of the block, by its place in it, all documents that are
    among its ``places`` best within a task."""
    spark = index.sparkSession
    vocabulary = sorted({t for _, terms in block for t in terms})
    sent = spark.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})

    def loose(data: bytes) -> bytes:
        return zstandard.ZstdDecompressor().decompress(data)

    def holders(batches):
        at = sent.value
        for b in batches:
            for terms, df in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ours = [(at[t], n) for t, n in zip(loose(terms).split(b" "), np.frombuffer(df, np.int32).tolist()) if t in at]
                yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in ours], pa.int32()), pa.array([n for _, n in ours], pa.int64())], ["term", "df"])

    df = dict(index.select("terms", "df").mapInArrow(holders, "term int, df long").groupBy("term").agg(F.sum("df")).collect())
    weights = {t: weight(n, n_docs) for t, n in df.items()}
    queries = [[(t, weights[t]) for t in (sent.value[w] for w in terms) if weights.get(t, 0) > 0] for _, terms in block]
    asked = spark.sparkContext.broadcast(queries)
    kind = index.schema["docs"].dataType.elementType
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("doc_id", kind), T.StructField("score", T.LongType())])

    def run(batches):
        at, queries = sent.value, asked.value
        held = [[] for _ in queries]  # per item: (score, id is null, id) of its best places so far
        kept_type = None
        for b in batches:
            kept_type = b.column(0).type.value_type
            for i in range(b.num_rows):
                ids, terms, _, depth, quarters, short = (b.column(k)[i].as_py() for k in range(6))
                row = {at[t]: r for r, t in enumerate(loose(terms).split(b" ")) if t in at}
                tree = Treap(depth, np.frombuffer(loose(quarters), np.uint8), np.frombuffer(loose(short), np.int32))
                for q, query in enumerate(queries):
                    here = [(row[t], w) for t, w in query if t in row]
                    if not here:
                        continue
                    best = held[q]
                    rows, ws = (np.array(x, np.int64) for x in zip(*here))
                    cols, scores = tree.best(rows, ws, places, best[-1][0] if len(best) == places else 1)
                    if len(cols):
                        best += [(s, ids[c] is None, ids[c]) for c, s in zip(cols.tolist(), scores.tolist())]
                        best.sort(key=lambda x: (-x[0], x[1], 0 if x[1] else x[2]))
                        del best[places:]
        for q, best in enumerate(held):
            if best:
                yield pa.RecordBatch.from_arrays([pa.array([q] * len(best), pa.int32()), pa.array([x[2] for x in best], kept_type), pa.array([x[0] for x in best], pa.int64())], schema.names)

    return index.mapInArrow(run, schema)


def search(index: DataFrame, items: DataFrame, n_docs: int, places: int = PLACES, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``places`` best documents with a score above 0."""
    spark = index.sparkSession
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    # first among the finds of some tasks, then among all: no group holds every task's finds
    some = Window.partitionBy("item", "part").orderBy(*order)
    every = Window.partitionBy("item").orderBy(*order)
    width = shuffle_width(spark)
    kind = index.schema["docs"].dataType.elementType
    out = None
    for first, block in _blocks(items, block_terms):
        found = _search(index, block, n_docs, places).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(max(1, math.isqrt(width)))))
        found = found.withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= places)
        found = found.withColumn("rank", F.row_number().over(every)).filter(F.col("rank") <= places)
        names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", items.schema["item_id"].dataType)]))
        part = found.join(names, "item").select("item_id", "rank", "doc_id", "score")
        part = stage(part, f"lexical-found-{first}")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], T.StructType([T.StructField("item_id", items.schema["item_id"].dataType), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", kind), T.StructField("score", T.LongType())]))
    return out


def rank_documents(docs: DataFrame, items: DataFrame, places: int = PLACES, shard_terms: int = SHARD_TERMS, shard_docs: int = SHARD_DOCS, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """Index ``docs`` and search it for all ``items`` (see the module's docstring)."""
    index, n_docs, _ = build_index(docs, shard_terms, shard_docs)
    return search(index, items, n_docs, places, block_terms)
