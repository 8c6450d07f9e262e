"""Document fingerprints: a Merkle tree over sections and paragraphs.

A text is cut after blank lines into sections and after line ends into paragraphs.
Pieces keep their separators, so the pieces of a text joined again are the text. A
paragraph's digest is the SHA-256 of its text, a section's that of its paragraphs'
digests, and the root that of its sections'. Equal roots mean equal texts; where roots
differ, the differing branches show the edit (``differing``).

For the likeness of two trees each paragraph carries its pieces, a level below: cuts
that depend on the text alone, after line ends and after white space whose word's hash
says so (one word in ``WORDS``). A word of more than ``LONG`` code points (a line of a
script without blanks, a key, markup) has cuts inside, by a hash of each ``GRAM`` code
points. An insertion moves no cut beyond its word, and a text of any script has pieces. The likeness is the share of characters in common over the distinct pieces,
2 * common / (all of one + all of the other); 1.0 for equal roots.

Defined cases: null text is the empty text; the empty text is one empty piece; texts of
any length are cut in linear time; rows that share an id follow each
other in order of their text hash; null ids come after all others; an empty table gives an empty result; extra
columns are ignored. No Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txsentry.llm.common import let

SECTION_END = r"(?<=\n\n)"
PARAGRAPH_END = r"(?<=\n)"
WORD_END = r"(?<=\s)(?=\S)"
WORDS, LONG, GRAM, GRAMS = 3, 24, 3, 8
CUT = "\x00"  # marks the end of a piece
LENGTH_BITS = 31  # no text is longer
BUCKET_ROWS = 512
MAX_BUCKETS = 1 << 14


def _sha(text: Column) -> Column:
    return F.sha2(text, 256)


def paragraphs(text: Column) -> Column:
    """Digest of each paragraph in order."""
    return F.transform(F.split(text, PARAGRAPH_END), _sha)


def root(text: Column) -> Column:
    """Root digest of the tree over ``text``."""
    return _sha(F.concat_ws(",", F.transform(F.split(text, SECTION_END), lambda s: _sha(F.concat_ws(",", paragraphs(s))))))


def differing(a: Column, b: Column) -> Column:
    """Numbers (from 0) of the paragraphs of ``a`` whose branch is not in ``b``."""
    mine, other = paragraphs(a), paragraphs(b)
    marked = F.transform(mine, lambda d, i: F.when(~F.array_contains(other, d), i))
    return F.filter(marked, lambda i: i.isNotNull())


def pieces(text: Column) -> Column:
    """The distinct pieces as numbers: a hash in the upper bits, the length in the lowest 31."""

    def chosen(key: Column, one_in: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(one_in)) == 0

    def inside(word: Column) -> Column:
        def one(signs: Column) -> Column:
            def gram(i: Column) -> Column:
                return F.concat(*[F.coalesce(F.get(signs, i - k), F.lit("")) for k in reversed(range(GRAM))])

            return F.array_join(F.transform(signs, lambda c, i: F.when(chosen(gram(i), GRAMS), F.concat(c, F.lit(CUT))).otherwise(c)), "")

        return let(F.split(word, ""), one)

    def ended(word: Column) -> Column:
        body = F.when(F.length(word) > LONG, inside(word)).otherwise(word)
        return F.when(word.endswith("\n") | chosen(word, WORDS), F.concat(body, F.lit(CUT))).otherwise(body)

    marked = F.array_join(F.transform(F.split(text, WORD_END), ended), "")
    found = F.filter(F.split(marked, CUT), lambda s: s != "")
    return F.array_distinct(F.transform(found, lambda s: F.shiftleft(F.xxhash64(s), LENGTH_BITS).bitwiseOR(F.length(s).cast("long"))))


def _weight(found: Column) -> Column:
    low = F.lit((1 << LENGTH_BITS) - 1).cast("long")
    return F.aggregate(found, F.lit(0).cast("long"), lambda acc, x: acc + x.bitwiseAND(low))


def likeness(a: Column, b: Column, equal: Column) -> Column:
    """Share of the pieces' characters in common; ``equal``: the roots are equal."""
    both = _weight(a) + _weight(b)
    return F.when(equal, 1.0).when(both == 0, 0.0).otherwise(2.0 * _weight(F.array_intersect(a, b)) / both)


def followed(docs: DataFrame, bucket_rows: int = BUCKET_ROWS, max_buckets: int = MAX_BUCKETS) -> DataFrame:
    """(doc_id, text, next_text) with the rows in descending id order, equal ids by text
    hash, the last row followed by the first.

    Texts are shuffled once. Rows go to buckets of neighbouring ids, whose bounds are
    quantiles of the ids (at most ``max_buckets`` numbers); a bucket's last row is
    followed by the first row of the next bucket, which is sent there as a guest.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("_h", F.xxhash64("text"))
    n = docs.count()
    cuts = max(1, min(max_buckets, n // bucket_rows))
    shares = [i / cuts for i in range(1, cuts)]
    bounds = (docs.agg(F.percentile_approx("doc_id", shares, max(10_000, 10 * cuts)).alias("b")).first()["b"] if shares else None) or []
    bounds = sorted(set(bounds))
    # binary search for the number of bounds that are not above the id
    steps = [1 << k for k in reversed(range(max(1, len(bounds)).bit_length()))]
    limits = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.expr("cast(array() as array<bigint>)")
    found = F.aggregate(
        F.array(*[F.lit(k) for k in steps]),
        F.lit(0),
        lambda at, k: F.when((at + k <= len(bounds)) & (F.get(limits, at + k - 1) <= F.col("doc_id")), at + k).otherwise(at),
    )
    bucket = F.when(F.col("doc_id").isNull(), -1).otherwise(found)
    # first row of each bucket: as many rows as there are buckets
    heads = docs.select(bucket.alias("b"), F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", (-F.xxhash64(F.coalesce("text", F.lit("")))).alias("h")).alias("r"))
    heads = sorted(((r["b"], r["r"]["doc_id"], -r["r"]["h"]) for r in heads.groupBy("b").agg(F.max("r").alias("r")).collect()), reverse=True)
    guests = [(heads[i][0], *heads[(i + 1) % len(heads)][1:]) for i in range(len(heads))]
    sent = F.broadcast(spark.createDataFrame(guests, "_b int, _id long, _gh long"))
    visiting = rows.join(sent, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_gh"))).select("doc_id", "text", "_h", "_b", F.lit(1).alias("_guest"))
    placed = rows.select("doc_id", "text", "_h", bucket.alias("_b"), F.lit(0).alias("_guest")).unionByName(visiting)
    here = Window.partitionBy("_b").orderBy("_guest", F.col("doc_id").desc_nulls_last(), "_h")
    return placed.withColumn("next_text", F.lead("text").over(here)).filter("_guest = 0").select("doc_id", "text", "next_text")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per document its tree's root, the root of its edited text and both likenesses.

    The edited text replaces the last third of the code points by the first as many of
    the next document in descending id order.
    """
    met = followed(docs)
    n = F.length("text")
    k = F.floor(n / 3).cast("int")
    met = met.select("doc_id", "text", "next_text", n.cast("long").alias("n_chars"), F.concat(F.substring("text", F.lit(1), n - k), F.substring("next_text", F.lit(1), k)).alias("_edited"))
    met = met.select(
        "doc_id",
        "n_chars",
        _sha(F.col("_edited")).alias("edited_sha256"),
        root(F.col("text")).alias("fingerprint"),
        root(F.col("_edited")).alias("edited_fingerprint"),
        pieces(F.col("text")).alias("_a"),
        pieces(F.col("_edited")).alias("_b"),
        pieces(F.col("next_text")).alias("_c"),
        (F.col("text") == F.col("next_text")).alias("_same_next"),
    )
    return met.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("_a"), F.col("_b"), F.col("fingerprint") == F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("_a"), F.col("_c"), F.col("_same_next")).alias("near_next"),
    )
