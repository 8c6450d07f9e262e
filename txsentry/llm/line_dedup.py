"""Line dedup by a log-template tree.

A text is parsed into lines, and each line into pieces: a piece ends with a sentence (a stop,
closing quotes and brackets, a stop of CJK text), and a stretch of more than ``LONG_PIECE``
tokens without one is cut after each word whose hash is the least of the ``REACH`` words
on either side, so that a passage pasted into it has pieces of its own. On the way every token with a digit
becomes ``<*>``.

Lines go down a tree of fixed depth: token count, leading token, trailing token. First, equal
lines and pieces are found: a key met in ``min_docs`` or more documents recurs, the document
with the smallest id keeps it, all others drop it. Then the lines that are left meet in their
leaves, and the leaf tells which of their fields vary: a token stays in the template if that
token stands at that place in two documents' lines of the leaf, else the place becomes ``<*>``.
Lines with the same template, at least ``CONSTANT`` of it constant, recur as before. Support
is counted over the whole leaf at once, so the order of rows plays no part.

So that clean text stays as it is, chance repeats of a few words don't count. Recurring
neighbours are taken together, however many: a run of recurring lines goes if it has
``min_line_tokens``, a run of recurring pieces inside a line if it has
``min_sentence_tokens`` in pieces of three tokens or more. A line all of whose pieces
recur is a recurring line.

Defined cases: null text stays null, empty text stays empty and has no units; a document
all of whose units recur keeps its row with the empty text; rows that share an id count
as one document; rows without an id come after all ids and are told apart by their text
(equal ones are one document); ids may be of any orderable type; an empty table gives an
empty result; extra columns are kept. No Python runs on the executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txsentry.llm.common import let, stage

MIN_DOCS = 2
MIN_LINE_TOKENS = 3
MIN_SENTENCE_TOKENS = 8
SHORT_PIECE = 3  # pieces of fewer tokens extend a run but don't count
LONG_PIECE = 24
REACH = 2
CONSTANT = 0.7  # constant share of a template with variable fields
MIN_CONSTANT = 5  # and its least number of constant tokens
HOT_SHARE = 2000

FIELD = r"(?<!\S)[^\s\d]*+\d\S*"
WIDE = "\t\r\x0B\f"
BLANKS = r"[\t\r\x0B\f]|  "
CLOSERS = "\"'’”»)\\]」』）"
QUOTED = rf"([.!?…][{CLOSERS}]++) "
CJK_STOP = rf"([。！？][{CLOSERS}]*+)(?=\S)"
RARE = rf"[.!?][{CLOSERS}]"
FAR = "[…-。！-？]"  # holds the stops beyond ASCII (in two ranges: fewer tests a sign)
CUT = "\x0B"  # ends a piece, in place of the space there
GLUE = "\f"  # before a CUT where the text has no space; both are white space for FIELD
NO_ID = 2**62


def _id(docs: DataFrame) -> Column:
    """The document's id; without one, a value from its text that lies above any id."""
    alone = F.shiftrightunsigned(F.xxhash64("text"), 2).bitwiseOR(F.lit(NO_ID))
    if isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        return F.coalesce(F.col("doc_id").cast("long"), alone)
    none = F.col("doc_id").isNull()
    return F.struct(none.alias("none"), F.col("doc_id").alias("id"), F.when(none, alone).alias("alone"))


def _row(docs: DataFrame) -> Column:
    """One number for a row, from its id and its text."""
    return F.xxhash64(_id(docs), F.col("text"))


def _any(text: Column, signs) -> Column:
    return reduce(Column.__or__, [text.contains(s) for s in signs])


def _loose(text: Column) -> Column:
    """Has white space that is not single spaces (or line ends)."""
    return _any(text, ["  ", *WIDE])


def _far(text: Column) -> Column:
    """Has signs beyond ASCII."""
    return F.length(text) != F.octet_length(text)


def _spaced(text: Column) -> Column:
    """The text with single spaces."""
    return F.regexp_replace(text, r"[ \t\r\x0B\f]+", " ")


def _marked(text: Column) -> Column:
    """The text with single spaces, and ``CUT`` after each sentence."""

    def rare(t: Column) -> Column:
        t = F.regexp_replace(t, QUOTED, "$1" + CUT)
        for end in "…。！？":
            t = F.replace(t, F.lit(end + " "), F.lit(end + CUT))
        return F.regexp_replace(t, CJK_STOP, "$1" + GLUE + CUT)

    # each step once, and the costly ones only where their signs occur. A pattern passes over a text many
    # times slower than a search for bytes, so patterns are tried only where such a search finds cause
    quoted = [c + " " for c in "\"')]"]
    text = let(text, lambda t: F.when(_loose(t) | (_any(t, quoted) & t.rlike(RARE)) | (_far(t) & (t.rlike(FAR) | t.rlike(RARE))), rare(_spaced(t))).otherwise(t))
    for end in ".!?":
        text = F.replace(text, F.lit(end + " "), F.lit(end + CUT))
    return text


def _masked(marked: Column) -> Column:
    """The marked text with its variable fields generalised."""
    return let(marked, lambda m: F.when(m.rlike(r"\d"), F.regexp_replace(m, FIELD, "<*>")).otherwise(m))


def _bare(line: Column) -> Column:
    """The line without white space around it; ``line`` is named several times, so not a costly expression."""
    ends = " " + CUT + GLUE  # trimming by a set of signs lists all places of a text, so only where it is needed
    loose = reduce(Column.__or__, [line.startswith(e) | line.endswith(e) for e in ends])
    return F.when(loose, F.btrim(line, F.lit(ends))).otherwise(line)


def _plain(unit: Column) -> Column:
    return F.replace(unit, F.lit(CUT), F.lit(" "))


def _field_tokens(line: Column) -> Column:
    """The tokens of a line of the text as they stand in the tree; its pieces don't matter here."""
    glued = let(line, lambda t: F.when(_loose(t) | (_far(t) & t.rlike(FAR)), F.regexp_replace(_spaced(t), CJK_STOP, "$1" + GLUE + " ")).otherwise(t))
    return F.split(let(_masked(glued), _bare), " ")


def _cut_long(piece: Column, shown: Column | None = None) -> Column:
    """A long piece in parts, or as they stand in ``shown`` (a piece of as many tokens)."""

    def joined(tokens: Column, h: Column) -> Column:
        def mark(own: Column, i: Column) -> Column:
            # beyond either end there is no hash, and null is no reason to go on
            goes_on = [own > F.get(h, i + k) for k in range(-REACH, REACH + 1) if k]
            s = F.get(tokens, i)
            return F.when(reduce(Column.__or__, goes_on), s).otherwise(F.concat(s, F.lit("\n")))

        return F.array_join(F.transform(h, mark), " ")

    def marks(tokens: Column) -> Column:
        hashes = F.transform(tokens, lambda t: F.xxhash64(t))
        if shown is None:
            return let(hashes, lambda h: joined(tokens, h))
        return let(F.split(shown, " "), lambda own: let(hashes, lambda h: joined(own, h)))

    # split at one sign, which needs no pattern
    whole = F.replace(let(F.split(piece, " "), marks), F.lit("\n "), F.lit("\n"))
    return F.split(let(whole, lambda w: F.when(w.endswith("\n"), F.rtrim(w, F.lit("\n"))).otherwise(w)), "\n")


def _tokens(plain: Column) -> Column:
    """Token count of a bare unit without ``CUT`` that is not empty."""
    return F.octet_length(plain) - F.octet_length(F.replace(plain, F.lit(" "), F.lit(""))) + 1


def _pieces(line: Column, n: Column, shown: Column | None = None) -> Column:
    """The pieces of a bare masked line of ``n`` tokens, or those of the line ``shown`` (marked, not masked)."""

    def parts(m: Column, s: Column | None = None) -> Column:
        return F.when((F.octet_length(m) > 2 * LONG_PIECE) & (_tokens(m) > LONG_PIECE), _cut_long(m, s)).otherwise(F.array(m if s is None else s))

    if shown is None:
        return F.when(n > LONG_PIECE, F.flatten(F.transform(F.split(line, CUT), lambda m: parts(m)))).otherwise(F.split(line, CUT))
    return F.when(n > LONG_PIECE, F.flatten(F.zip_with(F.split(line, CUT), F.split(shown, CUT), parts))).otherwise(F.split(shown, CUT))


def parsed_units(docs: DataFrame) -> DataFrame:
    """(id, rid, line, piece, of, n, key, leaf): each row's lines that are not blank (piece 0, with
    their leaf of the tree) and the pieces 1, 2, ... of lines that have several (``of``), with
    token counts and keys. Numbers only; texts are parsed once."""
    # a row's numbers below the generator: above it they would be taken, with the whole text, once per
    # line; the generators' arrays are expressions, as a column of arrays is computed again in a filter
    rows = docs.select(_id(docs).alias("id"), _row(docs).alias("rid"), F.col("text").rlike(r"\d").alias("fields"), _marked(F.col("text")).alias("m"))
    lines = rows.select("id", "rid", "fields", F.posexplode(F.split("m", "\n")).alias("line", "t"))
    lines = lines.select("id", "rid", "fields", "line", _bare(F.col("t")).alias("t")).filter("t <> ''")
    # of a text with digits only the lines that have some are masked: that pattern is slow
    lines = lines.select("id", "rid", "line", F.when(F.col("fields"), _masked(F.col("t"))).otherwise(F.col("t")).alias("t"))
    lines = lines.select("*", _plain(F.col("t")).alias("plain"))
    leaf = F.xxhash64("tokens", F.substring_index("plain", " ", 1), F.substring_index("plain", " ", -1))
    lines = lines.select("*", _tokens(F.col("plain")).alias("tokens")).select("id", "rid", "line", "t", "tokens", leaf.alias("leaf"))
    lines = lines.select("*", F.when((F.instr("t", CUT) > 0) | (F.col("tokens") > LONG_PIECE), _pieces(F.col("t"), F.col("tokens"))).alias("p"))
    several = F.when(F.size("p") > 1, F.concat(F.array("t"), F.col("p"))).otherwise(F.array("t"))
    lines = lines.select("*", F.coalesce(F.size("p"), F.lit(1)).alias("of"))
    units = lines.select("id", "rid", "line", "of", "tokens", "leaf", F.posexplode(several).alias("piece", "u"))
    whole = F.col("piece") == 0
    n = F.when(whole, F.col("tokens")).otherwise(_tokens(F.col("u")))
    return units.select("id", "rid", "line", "piece", "of", n.alias("n"), F.xxhash64("u").alias("key"), F.when(whole, F.col("leaf")).alias("leaf"))


def recurring(u: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(key, first_id, n) of each key in ``u`` that ``min_docs`` documents or more
    hold; n counts its units (documents, if more than two are asked for).

    Counts are combined before the shuffle, so a template in a third of all documents is
    one row per task. For two documents the smallest and largest id tell; for more the
    distinct ids of a key are counted.
    """
    if min_docs > 2:
        u = u.select("id", "key").distinct()
    found = u.groupBy("key").agg(F.min("id").alias("first_id"), F.max("id").alias("_last"), F.count(F.lit(1)).alias("n"))
    return found.filter("first_id <> _last" if min_docs <= 2 else F.col("n") >= min_docs).select("key", "first_id", F.col("n").alias("units"))


def with_first(u: DataFrame, found: DataFrame, total: int) -> DataFrame:
    """The units of ``u`` whose key is in ``found``, with ``first_id``. ``total``: their number.

    Very frequent keys, at least one in ``HOT_SHARE`` of all units and so at most
    ``HOT_SHARE`` keys, are joined by broadcast, so their units stay where they are; the
    others meet by a shuffle in which no key is large. There the found keys, each once, are
    hashed, so the far more numerous units need no sorting.
    """
    least = total / HOT_SHARE
    hot = F.broadcast(found.filter(F.col("units") > least).select("key", "first_id"))
    few = found.filter(F.col("units") <= least).select("key", "first_id").hint("shuffle_hash")
    rest = u.join(hot.select("key"), "key", "left_anti").join(few, "key")
    return u.join(hot, "key").unionByName(rest)


ROW = ["id", "rid"]  # a row of the documents
PLACE = [*ROW, "line"]


def _runs(rows: DataFrame, by: list[str], at: str, total: Column) -> DataFrame:
    """``rows`` with ``run``: the total of all rows beside each other in ``at``."""
    rows = rows.withColumn("_run", F.col(at) - F.row_number().over(Window.partitionBy(*by).orderBy(at)))
    return rows.withColumn("run", F.sum(total).over(Window.partitionBy(*by, "_run"))).drop("_run")


def repeats(units: DataFrame, min_docs: int, min_line_tokens: int, min_sentence_tokens: int) -> tuple[DataFrame, DataFrame]:
    """Equal lines and pieces that recur: places of lines to go, and (place, piece) of pieces to go
    inside other lines."""
    found = stage(recurring(units.select("id", "key"), min_docs), "line-keys")
    gone = with_first(units.drop("leaf"), found, units.count()).filter("id <> first_id")
    inner = F.col("piece") > 0
    # per line: does it recur itself, do all its pieces, and may its pieces make a run?
    # (rows that come twice have each piece once)
    ordered, line = Window.partitionBy(*PLACE).orderBy("piece"), Window.partitionBy(*PLACE)
    gone = gone.select(*PLACE, "piece", "of", "n", F.lag("piece").over(ordered).alias("_before")).filter("_before is null or _before <> piece")
    total = {
        "whole": F.max(F.when(~inner, F.col("n"))),
        "away": F.count_if(inner),
        "inside": F.sum(F.when(inner, F.col("n"))),
        "weight": F.sum(F.when(inner & (F.col("n") >= SHORT_PIECE), F.col("n"))),
    }
    gone = gone.select(*PLACE, "piece", "n", "of", F.col("_before").isNull().alias("first"), *[v.over(line).alias(k) for k, v in total.items()])
    all_of_it = F.col("whole").isNotNull() | (F.col("away") == F.col("of"))
    tokens = F.coalesce("whole", "inside")
    is_full = F.col("first") & all_of_it
    may_run = inner & (F.col("weight") >= min_sentence_tokens) & ~(all_of_it & (tokens >= min_line_tokens))
    marked = gone.select(*PLACE, "piece", "n", tokens.alias("tokens"), is_full.alias("full"), may_run.alias("run_piece"))
    marked = stage(marked.filter("full or run_piece"), "line-recurring")
    lines = _runs(marked.filter("full").select(*PLACE, F.col("tokens").alias("n")), ROW, "line", F.col("n"))
    full = stage(lines.filter(F.col("run") >= min_line_tokens).select(*PLACE), "line-full")
    weight = F.when(F.col("n") >= SHORT_PIECE, F.col("n")).otherwise(0)
    pieces = marked.filter("run_piece").select(*PLACE, "piece", "n")
    pieces = _runs(pieces, PLACE, "piece", weight).filter(F.col("run") >= min_sentence_tokens).select(*PLACE, "piece")
    return full, pieces


def templates(docs: DataFrame, units: DataFrame, gone: DataFrame, min_docs: int, min_line_tokens: int) -> DataFrame:
    """Places of lines to go because another document has a line of the same template with
    variable fields, among the lines that are not ``gone`` already."""
    lines = units.filter((F.col("piece") == 0) & (F.col("n") >= max(min_line_tokens, MIN_CONSTANT)))
    left = stage(lines.select(*PLACE, "n", "leaf").join(gone, PLACE, "left_anti"), "line-left")
    shared = left.groupBy("leaf").agg(F.min("id").alias("_a"), F.max("id").alias("_b")).filter("_a <> _b").select("leaf")
    held = left.join(shared, "leaf", "left_semi").groupBy(*ROW).agg(F.collect_set(F.struct("line", "leaf", "n")).alias("held"))
    # the texts of these lines, from the rows that have any; rows alike in id and text once
    texts = docs.select(_id(docs).alias("id"), _row(docs).alias("rid"), "text").join(held, ROW)
    texts = texts.dropDuplicates(ROW)
    taken = let(F.split("text", "\n"), lambda all_: F.transform("held", lambda h: F.struct(h["line"].alias("line"), h["leaf"].alias("leaf"), h["n"].alias("n"), F.get(all_, h["line"]).alias("t"))))
    lines = texts.select(*ROW, F.inline(taken))
    fields = lines.select(*PLACE, "leaf", "n", F.posexplode(_field_tokens(F.col("t"))).alias("at", "token"))
    fields = stage(fields.select(*PLACE, "leaf", "n", "at", F.xxhash64("leaf", "at", "token").alias("key")), "line-fields")
    constant = stage(recurring(fields.select("id", "key"), 2).select("key"), "line-constants")
    # a template is the set of its constant tokens, each known by leaf, place and token
    met = fields.join(constant.hint("shuffle_hash"), "key")
    per_line = met.groupBy(*PLACE, "leaf", "n").agg(F.count(F.lit(1)).alias("constant"), F.bit_xor("key").alias("_x"))
    enough = (F.col("constant") >= CONSTANT * F.col("n")) & (F.col("constant") >= MIN_CONSTANT)
    keyed = stage(per_line.filter(enough).select(*PLACE, F.xxhash64("leaf", "_x").alias("key")), "line-templates")
    found = recurring(keyed.select("id", "key"), min_docs)
    return with_first(keyed, found, keyed.count()).filter("id <> first_id").select(*PLACE)


def dedup_lines(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    min_line_tokens: int = MIN_LINE_TOKENS,
    min_sentence_tokens: int = MIN_SENTENCE_TOKENS,
) -> DataFrame:
    """``docs`` with recurring templates dropped from ``text``; adds ``dropped_lines``
    and ``dropped_sentences`` (pieces inside lines; 0 where nothing was dropped)."""
    units = stage(parsed_units(docs), "line-units")
    full, inside = repeats(units, min_docs, min_line_tokens, min_sentence_tokens)
    full = stage(full.unionByName(templates(docs, units, full, min_docs, min_line_tokens)), "line-gone")
    inside = inside.groupBy(*PLACE).agg(F.sort_array(F.collect_list(F.col("piece") - 1)).alias("cut")).join(full, PLACE, "left_anti")
    every = full.withColumn("cut", F.lit(None).cast("array<int>")).unionByName(inside)
    drops = every.groupBy(*ROW).agg(F.sort_array(F.collect_list(F.struct("line", "cut"))).alias("_drops"))
    drops = drops.select(F.col("id").alias("_id"), F.col("rid").alias("_rid"), "_drops")
    met = docs.join(drops, (_row(docs) == F.col("_rid")) & (_id(docs) == F.col("_id")), "left")

    def between(whole: Column, places: Column, instead=None) -> Column:
        """The elements of ``whole`` without those at ``places`` (ascending), or with
        ``instead(element, i-th place)`` for each; slices, so the work is linear."""

        def stretch(_: Column, i: Column) -> Column:
            before = F.coalesce(F.get(places, i - 1), F.lit(-1))
            end = F.coalesce(F.get(places, i), F.size(whole))
            kept = F.slice(whole, before + 2, end - before - 1)
            return kept if instead is None else F.concat(kept, F.when(i < F.size(places), instead(F.get(whole, end), i)).otherwise(F.array().cast("array<string>")))

        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(places)), stretch))

    def shorter(line: Column, cut: Column) -> Column:
        """The line without the pieces at ``cut``."""

        def rest(marked: Column) -> Column:
            left = F.array_join(let(let(_masked(marked), lambda m: _pieces(m, _tokens(_plain(m)), marked)), lambda p: between(p, cut)), " ")
            return F.replace(F.replace(F.replace(left, F.lit(CUT), F.lit(" ")), F.lit(GLUE + " "), F.lit("")), F.lit(GLUE), F.lit(""))

        return let(let(_marked(line), _bare), rest)

    def one(line: Column, i: Column) -> Column:
        cut = F.get(F.col("_drops"), i)["cut"]
        return F.when(cut.isNull(), F.array().cast("array<string>")).otherwise(F.array(shorter(line, cut)))

    places = F.transform("_drops", lambda d: d["line"])
    text = F.array_join(let(F.split("text", "\n"), lambda whole: let(places, lambda p: between(whole, p, one))), "\n")
    lost = F.filter("_drops", lambda d: d["cut"].isNull())
    within = F.aggregate("_drops", F.lit(0).cast("long"), lambda s, d: s + F.coalesce(F.size(d["cut"]), F.lit(0)))
    out = [F.when(F.col("_drops").isNotNull(), text).otherwise(F.col("text")).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return met.select(*out, F.coalesce(F.size(lost), F.lit(0)).cast("long").alias("dropped_lines"), F.coalesce(within, F.lit(0).cast("long")).alias("dropped_sentences"))
