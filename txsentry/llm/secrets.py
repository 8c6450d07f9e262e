"""Secret scan with a random forest that removes false positives.

Findings are long runs of key signs with a digit or mixed case, and values of any
length and signs that are assigned to a name of a secret. Each gets features: its
length, its character transitions and shares of character kinds, the share of its
letters that are words of the corpus dictionary, its path (slashes, dots, an address
before it, the source of the document) and the words beside it (names such as token or
password, an assignment sign, a quote). A random forest trained on labelled findings
gives each finding a probability; findings under ``THRESHOLD`` are false positives.

Labelled findings come as a table (finding, secret), or, by default, from providers'
fixed formats and from assignments to a name of a secret (secret), and from plain
numbers, words and names with a number (no secret); ``labelled_findings``. The forest is
fitted on at most about ``SAMPLE`` of them and judges all findings.

The dictionary holds the words of three letters and more that occur at least
``MIN_COUNT`` times, counted over all documents; only words that occur in findings are
looked up.

Defined cases: null and empty texts have no findings; a null source is a path of its
own; a text may hold any number of findings, each its own row, numbered from 1; with
labelled findings of one kind only, all findings get that kind, and with none they all
stay (probability null, secret); repeated rows give repeated findings; an empty table
gives an empty result; extra columns are ignored. No Python runs on the executors.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txsentry.llm.common import stage

LEAST = 14  # characters
THRESHOLD = 0.5
MIN_COUNT = 5
SAMPLE = 50_000
TREES, DEPTH = 30, 6

# a digit, a capital after a small letter, or a small letter after two capitals
MIXED = r"(?=[A-Za-z+/_\-]*(?:\d|[a-z][+/_\-]*[A-Z]|[A-Z][+/_\-]*[A-Z][+/_\-]*[a-z]))"
FINDING = rf"(?<![A-Za-z0-9+/_\-]){MIXED}[A-Za-z0-9+/_\-]{{{LEAST},}}+=?=?"

# Names of secrets, and key formats of providers.
SECRET_NAME = r"(?i)(token|secret|passw(or)?d|pwd|api_?key|access_?key|credential|bearer|auth)"

# A value assigned to a name of a secret, in quotes or up to white space, unless it is a
# finding by itself.
QUOTE, TAIL = "[\"'`]", r"\"'`,;.)\]}>"
ASSIGNED = SECRET_NAME.replace("(?i)(", "(?i:").replace("(or)", "(?:or)") + rf"\w*+{QUOTE}?[^\S\n]*(?::=|=>|={{1,3}}|:)[^\S\n]*(?:(?i:bearer|basic)[^\S\n]+)?"
QUOTED = "|".join(rf"{q}(?!{FINDING}{q})[^{q}\n]+{q}" for q in "\"'`")
BARE = rf"(?!\"[^\"\n]*\"|'[^'\n]*'|`[^`\n]*`)(?!{QUOTE}?{FINDING}[{TAIL}]*(?:\s|$)){QUOTE}?\S*[^\s{TAIL}]"
NAMED = rf"{ASSIGNED}(?:{QUOTED}|{BARE})"
PROVIDER = r"^(AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk_live_[A-Za-z0-9]{16,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35})$"

FEATURES = [
    "length", "transitions", "digits", "upper", "lower", "signs", "distinct", "hex", "dictionary",
    "slashes", "dots_before", "address", "source_rate", "secret_name", "assigned", "quoted", "word_before", "word_after",
]


def findings(docs: DataFrame) -> DataFrame:
    """(doc_id, source, number, finding, before, after): each finding with up to 40
    characters on both sides; named values follow the runs of a document."""
    held = docs.filter(F.col("text").rlike(rf"[A-Za-z0-9+/_\-]{{{LEAST}}}|{ASSIGNED}")).select(
        "doc_id",
        "source",
        F.regexp_extract_all("text", F.lit(FINDING), F.lit(0)).alias("found"),
        F.split("text", FINDING).alias("rest"),
        F.regexp_extract_all("text", F.lit(NAMED), F.lit(0)).alias("named"),
        F.split("text", NAMED).alias("others"),
    )
    held = held.filter((F.size("found") > 0) | (F.size("named") > 0))

    def sides(found: str, rest: str) -> Column:
        return F.arrays_zip(F.col(found).alias("f"), F.slice(rest, 1, F.size(found)).alias("b"), F.slice(rest, 2, F.size(found)).alias("a"))

    def side(z: Column, f: Column, head: Column, end: Column) -> Column:
        return F.struct(f.alias("f"), F.right(F.concat(z["b"], head), F.lit(40)).alias("b"), F.left(F.concat(end, z["a"]), F.lit(40)).alias("a"))

    def named(z: Column) -> Column:
        f, head, end = z["f"], rf"^{ASSIGNED}{QUOTE}?", f"{QUOTE}$"
        return side(z, F.regexp_replace(f, f"{head}|{end}", ""), F.regexp_extract(f, head, 0), F.regexp_extract(f, end, 0))

    runs = F.transform(sides("found", "rest"), lambda z: side(z, z["f"], F.lit(""), F.lit("")))
    each = held.select("doc_id", "source", F.posexplode(F.concat(runs, F.transform(sides("named", "others"), named))).alias("at", "x"))
    return each.select("doc_id", "source", (F.col("at") + 1).alias("number"), F.col("x.f").alias("finding"), F.coalesce("x.b", F.lit("")).alias("before"), F.coalesce("x.a", F.lit("")).alias("after"))


def dictionary(docs: DataFrame, wanted: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """The words in ``wanted`` (column word) that the corpus uses ``min_count`` times or more."""
    words = docs.select(F.explode(F.split(F.lower("text"), r"[^a-z]+")).alias("word")).filter(F.length("word") >= 3)
    used = words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)
    return used.join(wanted.select("word").distinct(), "word", "left_semi").select("word")


def features(docs: DataFrame) -> DataFrame:
    """``findings`` with a column for each of ``FEATURES``."""
    found = stage(findings(docs).withColumn("row", F.monotonically_increasing_id()), "secret-findings")
    parts = found.select("row", F.explode(F.split(F.lower("finding"), "[^a-z]+")).alias("word")).filter(F.length("word") >= 3)
    known = parts.join(dictionary(docs, parts), "word").groupBy("row").agg(F.sum(F.length("word")).alias("covered"))
    rates = found.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("finding").alias("own"))
    rates = rates.select(F.col("source").alias("_s"), (F.col("own") / F.col("n")).alias("source_rate"))
    f, b, a = F.col("finding"), F.col("before"), F.col("after")
    size = F.length(f).cast("double")

    def share(signs: str) -> Column:
        return F.regexp_count(f, F.lit(signs)) / size

    turns = r"(?<=[a-z])[^a-z]|(?<=[A-Z])[^A-Z]|(?<=[0-9])[^0-9]|(?<=[+/_=\-])[A-Za-z0-9]"
    met = found.join(known, "row", "left").join(rates, F.col("source").eqNullSafe(F.col("_s")))
    return met.select(
        "doc_id", "source", "number", "finding", "before", "after",
        size.alias("length"),
        (F.regexp_count(f, F.lit(turns)) / size).alias("transitions"),
        share("[0-9]").alias("digits"),
        share("[A-Z]").alias("upper"),
        share("[a-z]").alias("lower"),
        share(r"[+/_=\-]").alias("signs"),
        (F.size(F.array_distinct(F.split(f, ""))) / size).alias("distinct"),
        f.rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("double").alias("hex"),
        (F.coalesce("covered", F.lit(0)) / size).alias("dictionary"),
        share("/").alias("slashes"),
        b.rlike(r"[.@/][\w.]*$").cast("double").alias("dots_before"),
        b.rlike(r"(?i)(https?:|www\.|@)\S*$").cast("double").alias("address"),
        F.col("source_rate"),
        b.rlike(SECRET_NAME).cast("double").alias("secret_name"),
        b.rlike(r"[=:]\s*[\"']?$").cast("double").alias("assigned"),
        b.rlike(r"[\"']$").cast("double").alias("quoted"),
        F.length(F.regexp_extract(b, r"([A-Za-z]+)\W*$", 1)).cast("double").alias("word_before"),
        F.length(F.regexp_extract(a, r"^\W*([A-Za-z]+)", 1)).cast("double").alias("word_after"),
    )


def labelled_findings(found: DataFrame) -> DataFrame:
    """(finding, secret) for the findings whose kind a fixed rule tells."""
    f, b = F.col("finding"), F.col("before")
    named = (b.rlike(SECRET_NAME + r"\w*\s*[=:]\s*[\"']?$") | b.rlike(rf"{ASSIGNED}{QUOTE}?$")) & ~b.rlike(r"(?i)authors?\s*[=:]\s*[\"']?$")
    secret = named & f.rlike("[0-9]") & f.rlike("[A-Za-z]") & ~f.rlike(r"\s")
    joined = f.rlike(r"^[A-Z]?[a-z]+([-_/+][A-Z]?[a-z]+)+$") & ~named
    plain = f.rlike(r"^[0-9+\-/_]+$") | f.rlike(r"^[A-Za-z]+[-_/]?[0-9]{1,4}$") | f.rlike(r"^[a-z]+([-_/][a-z]+)+[-_/]?[0-9]*$") | b.rlike(r"(?i)https?:\S*$") | joined
    kind = F.when(f.rlike(PROVIDER) | secret, 1).when(plain, 0)
    return found.select("finding", kind.alias("secret")).filter("secret is not null").groupBy("finding").agg(F.max("secret").alias("secret"))


def scan(docs: DataFrame, labelled: DataFrame | None = None, sample: int = SAMPLE, seed: int = 9) -> DataFrame:
    """Per finding: doc_id, number, finding, length, labelled (its label, if any),
    probability, secret."""
    found = stage(features(docs), "secret-features")
    known = (labelled if labelled is not None else labelled_findings(found)).select(F.col("finding").alias("_f"), F.col("secret").cast("double").alias("label"))
    known = stage(known, "secret-labels")
    n = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    rows = found.join(known, F.col("finding") == F.col("_f"), "left").drop("_f")
    keep = ["doc_id", "number", "finding", F.length("finding").alias("length"), F.col("label").cast("int").alias("labelled")]
    if len(n) < 2:
        one = list(n)[0] if n else None
        return rows.select(*keep, F.lit(one).cast("double").alias("probability"), F.lit(bool(one) if n else True).alias("secret"))
    share = min(1.0, sample / sum(n.values()))
    picked = known.filter(F.pmod(F.xxhash64("_f"), F.lit(1 << 20)) < F.lit(share * (1 << 20)))
    # a finding that is repeated is learnt from once
    learn = found.join(picked, F.col("finding") == F.col("_f")).groupBy("finding", "label").agg(*[F.avg(c).alias(c) for c in FEATURES])
    join = VectorAssembler(inputCols=FEATURES, outputCol="x", handleInvalid="keep")
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=seed, probabilityCol="p")
    model = forest.fit(join.transform(stage(learn.orderBy("finding"), "secret-train")))
    out = model.transform(join.transform(rows)).withColumn("probability", vector_to_array("p")[1])
    return out.select(*keep, "probability", (F.col("probability") >= THRESHOLD).alias("secret"))
