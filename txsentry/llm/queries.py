"""Registered queries of the subpackage (``opN_<name>``) and their DuckDB SQL.

Each applies its operator with production parameters to the whole table and derives the
columns that its contract names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txsentry.llm import bpe, decontaminate, html_extract, language_id, language_model, lexical, line_dedup, merkle, mixing, secrets, simhash, spelling, toxicity
from txsentry.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprints(table(spark, sf_dir, "documents"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op5_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document what the template tree dropped and a digest of what is left."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    left = F.coalesce("text", F.lit(""))
    return out.select("doc_id", "dropped_lines", "dropped_sentences", F.length(left).cast("long").alias("n_chars"), F.sha2(left, 256).alias("text_sha256"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per finding its probability; the finding itself only as a digest."""
    out = secrets.scan(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "number", F.sha2("finding", 256).alias("finding_sha256"), F.col("length").cast("long").alias("length"), "labelled", "probability", "secret")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.log_likelihood(table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the number of its tokens and digests of their ids and decoded text."""
    import public_tokenizers  # names the vocabulary files of this box; the operator takes any path

    path = public_tokenizers.path("word_bpe_49k.json")
    out = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_merkle_fingerprints,
        op3_html_text,
        op4_language_id,
        op5_simhash_neardup,
        op6_line_dedup,
        op7_decontaminate,
        op8_mix_sources,
        op9_secret_scan,
        op10_lm_scoring,
        op11_lexical_search,
        op12_bpe_roundtrip,
        op13_spelling_variants,
    )
}

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = "coalesce(regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"

# Word windows of items and documents are joined as texts; no automaton.
_DECONTAMINATE = f"""
WITH items AS (SELECT item_id, {_ITEM_WORDS.format("text")} AS w FROM benchmark),
places AS (SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS g FROM places),
docs AS (SELECT doc_id, {_ITEM_WORDS.format("text")} AS w FROM documents),
spots AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
hits AS (
  SELECT DISTINCT s.doc_id, s.i, s.n, x.item_id
  FROM (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS g FROM spots) AS s JOIN windows AS x ON s.n = x.n AND s.g = x.g
),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(t.n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(t.names, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM docs AS d LEFT JOIN hit_words AS h ON d.doc_id = h.doc_id LEFT JOIN hit_items AS t ON d.doc_id = t.doc_id
"""

# The share per weight in closed form: sources in order of bound / weight, the first so
# many of them capped, as long as the share of the others would exceed their bound.
_MIX = r"""
WITH sized AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
per_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight, 3 * source_size AS bound FROM per_source),
ordered AS (
  SELECT *, row_number() OVER o AS k, coalesce(sum(bound) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
         sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free, sum(source_size) OVER () AS total
  FROM weighed WINDOW o AS (ORDER BY CAST(bound AS DOUBLE) / weight, source NULLS LAST)
),
share AS (
  SELECT CAST(total - held AS DOUBLE) / free AS s FROM ordered WHERE bound > weight * (CAST(total - held AS DOUBLE) / free) ORDER BY k LIMIT 1
),
targets AS (
  SELECT source, source_size, least(CAST(bound AS DOUBLE), weight * coalesce((SELECT s FROM share), CAST(bound AS DOUBLE))) AS target FROM weighed
),
placed AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) AS r,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0e0 END AS rate,
         CAST(('0x' || substr(md5('8:' || coalesce(d.source, 'null')), 1, 8)) AS BIGINT) / 4294967296e0 AS u
  FROM sized AS d JOIN targets AS t ON d.source IS NOT DISTINCT FROM t.source
),
drawn AS (SELECT *, CAST(floor(u + rate * r) - floor(u + rate * (r - 1)) AS BIGINT) AS copies FROM placed)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, copies * CAST(size AS BIGINT) AS taken, copies, source FROM drawn
"""

_TERMS = "coalesce(regexp_extract_all(" + _LOWER.format("text") + r", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), [])"

_SEARCH = f"""
WITH docs AS (SELECT row_number() OVER () AS k, doc_id, {_TERMS} AS w FROM documents),
totals AS (SELECT count(*) AS nd, CAST(sum(len(w)) AS BIGINT) AS nt FROM docs WHERE len(w) > 0),
tfs AS (SELECT k, t, CAST(count(*) AS BIGINT) AS tf FROM (SELECT k, unnest(w) AS t FROM docs) GROUP BY k, t),
dfs AS (SELECT t, CAST(floor(1000e0 * ln(CAST(2 * any_value(nd) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight FROM tfs, totals GROUP BY t),
sizes AS (SELECT k, doc_id, 100 - 50 + (50 * CAST(len(w) AS BIGINT) * nd) // nt AS m FROM docs, totals WHERE len(w) > 0),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS t FROM benchmark),
scores AS (
  SELECT a.item_id, s.k, s.doc_id, CAST(sum(f.weight * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * s.m))) AS BIGINT) AS score
  FROM asked AS a JOIN dfs AS f ON a.t = f.t JOIN tfs AS tf ON a.t = tf.t JOIN sizes AS s ON tf.k = s.k GROUP BY a.item_id, s.k, s.doc_id
),
placed AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 50
"""

ORACLES: dict[str, str] = {"op11_lexical_search": _SEARCH, "op7_decontaminate": _DECONTAMINATE, "op8_mix_sources": _MIX}
