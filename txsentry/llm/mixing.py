"""Mixing sources to target weights by systematic sampling.

Each source gets a target number of words: weights 1, 2, 3 repeat over the sources in
code-point order (null last) and share the whole corpus size; a target stops at
``max_repeat`` times its source's size and the excess is reshared by weight. A document
of a source is then expected ``target / size`` times. Inside a source the documents are
put in order of size (then id), their expected copies are prefix-summed, one random
offset per source is added, and a document is emitted once for each integer boundary
that its interval crosses. The order by size makes the sample stratified over sizes, so
the words taken come within about one longest document of the target.

Defined cases: null text has size 0; a null source is a source of its own, after all
others; sources of size 0 have target 0 and their documents are not taken; an empty
table gives an empty result; repeated rows are separate documents; rows equal in size
and id are interchangeable; extra columns are ignored by ``mix`` and kept by
``emit``. No Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txsentry.llm.common import ranked, stage, word_count

MAX_REPEAT = 3
CYCLE = 3  # weights 1, 2, ..., CYCLE, repeating
SEED = 8


def source_targets(sizes: DataFrame, cycle: int = CYCLE, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``sizes`` has one row per source: (source, source_size). Adds weight and target.

    The share per weight is raised round by round; a source that reaches its bound stays
    there. Only two sums a round come to the driver, and the share only grows, so the
    rounds end when no further source is capped.
    """
    w = stage(ranked(sizes, [], [F.col("source").asc_nulls_last()], "mix-sources").withColumn("weight", F.pmod(F.col("rank") - 1, F.lit(cycle)) + 1).drop("rank"), "mix-weights")
    bound = F.col("source_size") * max_repeat
    total = w.agg(F.sum("source_size")).first()[0] or 0
    share = 0.0
    while True:
        capped = bound <= F.col("weight") * F.lit(share)
        held, free = w.agg(F.coalesce(F.sum(F.when(capped, bound)), F.lit(0)), F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0))).first()
        if not free:
            break
        rise = (total - held) / free
        if rise <= share:
            break
        share = rise
    return w.withColumn("target", F.least(bound.cast("double"), F.col("weight") * F.lit(share)))


def offset(source: str, seed: int = SEED):
    """One uniform number in [0, 1) per source, the same in every run."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(source), F.lit("null")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mix(docs: DataFrame, cycle: int = CYCLE, max_repeat: int = MAX_REPEAT, seed: int = SEED, key: list[str] | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, source): doc_id, source, size, source_size,
    target, copies, taken. ``key`` names further columns to carry."""
    extra = [c for c in (key or []) if c not in ("doc_id", "source")]
    sized = docs.select("doc_id", "source", *extra, word_count(F.col("text")).alias("size"))
    placed = stage(ranked(sized, ["source"], [F.col("size"), F.col("doc_id").asc_nulls_last(), *[F.col(c) for c in extra]], "mix-docs"), "mix-ranked")
    targets = source_targets(placed.groupBy("source").agg(F.sum("size").alias("source_size")), cycle, max_repeat)
    targets = targets.select(F.col("source").alias("_s"), "source_size", "target")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    u = offset("source", seed)
    copies = (F.floor(u + rate * F.col("rank")) - F.floor(u + rate * (F.col("rank") - 1))).cast("long")
    out = placed.join(targets, F.col("source").eqNullSafe(F.col("_s"))).withColumn("copies", copies)
    return out.select("doc_id", "source", *extra, "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def emit(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as it was drawn, with its columns
    and ``copy`` (1, 2, ...).

    Rows meet their draws by id and a hash of the text; rows alike in both share the
    draws of their group evenly.
    """
    keyed = docs.withColumn("_h", F.xxhash64(F.col("text")))
    same = ["doc_id", "source", "_h"]
    drawn = mix(keyed, key=["_h"], **options).groupBy(*same).agg(F.sum("copies").alias("_c"), F.count(F.lit(1)).alias("_k"))
    drawn = drawn.filter("_c > 0").select(*[F.col(c).alias(f"_d{c}") for c in same], "_c", "_k")
    on = F.lit(True)
    for c in same:
        on = on & F.col(c).eqNullSafe(F.col(f"_d{c}"))
    met = keyed.join(drawn, on).withColumn("_rn", F.row_number().over(Window.partitionBy(*same).orderBy(F.lit(0))))
    times = (F.floor(F.col("_c") / F.col("_k")) + F.when(F.col("_rn") <= F.col("_c") % F.col("_k"), 1).otherwise(0)).cast("int")
    out = met.withColumn("_t", times).filter("_t > 0")
    return out.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("_t"))).alias("copy"))
