"""Language ID: multinomial naive Bayes over hashed character n-grams.

Text is lower-cased, every run of signs that are no letters becomes one space, and each
place yields the n-grams of one to three characters that end there, hashed to ``BINS``
bins. Each training task adds up dense counts per language and reports them once at its
end, so what is shuffled is bounded by tasks x languages x bins. The log-probability
matrix (languages x bins) is broadcast, and documents are scored in batches: gathers
from the matrix, summed per document.

Defined cases: a null text or one without a letter is ``und`` with score 0, and so is
every text if nothing was learnt; rows with null language are not learnt from; a null id
counts as the empty id text; ties go to the language that sorts first; texts of any
length are read whole, in slabs; repeated rows count and score like others; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txsentry.llm.common import crc_mod

FOLDS = 3
HELD_OUT = 1
BITS = 15
BINS = 1 << BITS
SLAB = 1 << 21  # characters hashed at once
UNKNOWN = "und"

_ALPHA: list[np.ndarray] = []


def _alpha() -> np.ndarray:
    """For each code point whether it is a letter (made once a process)."""
    if not _ALPHA:
        _ALPHA.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), np.bool_, 0x110000))
    return _ALPHA[0]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams of several texts: an array (3, places) of bins, the first place of
    each text, and whether each text has a letter."""
    # two spaces before each text: its n-grams don't reach into the one before
    joined = np.frombuffer("".join("  " + t.lower() for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t.lower()) + 2 for t in texts], np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    letter = _alpha()[joined]
    spaced = np.where(letter, joined, np.uint32(32))
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one space after a word
    keep[starts] = keep[starts + 1] = True
    at = np.concatenate(([0], np.cumsum(keep)))
    c = spaced[keep]
    one = np.concatenate((np.full(2, 32, np.uint32), c))
    a, b = one[:-2].copy(), one[1:-1].copy()
    first = at[starts]
    a[first] = b[first] = a[first + 1] = 32
    shift = np.uint32(32 - BITS)
    with np.errstate(over="ignore"):
        bins = np.stack(
            [
                (c * np.uint32(2654435761) + np.uint32(97)) >> shift,
                ((b * np.uint32(40503) + c) * np.uint32(2246822519) + np.uint32(193)) >> shift,
                (((a * np.uint32(40503) + b) * np.uint32(40503) + c) * np.uint32(3266489917) + np.uint32(389)) >> shift,
            ]
        )
    has = np.add.reduceat(letter.astype(np.int64), starts) > 0
    return bins, at[starts], has


def slabs(texts: list[str | None]):
    """Ranges of texts of about ``SLAB`` characters each; a long text is a slab of its own."""
    first = n = 0
    for i, t in enumerate(texts):
        if n and n + len(t or "") > SLAB:
            yield first, i
            first, n = i, 0
        n += len(t or "") + 2
    if first < len(texts):
        yield first, len(texts)


def counts(docs: DataFrame) -> DataFrame:
    """(lang, bin, n): n-gram counts of the training documents; bin -1 counts documents."""

    def run(batches):
        held: dict[str, np.ndarray] = {}
        docs_of: dict[str, int] = {}
        for b in batches:
            texts, langs = b.column(0).to_pylist(), b.column(1).to_pylist()
            by: dict[str, list[str]] = {}
            for t, g in zip(texts, langs):
                by.setdefault(g, []).append(t)
            for g, own in by.items():
                total = held.setdefault(g, np.zeros(BINS, np.int64))
                docs_of[g] = docs_of.get(g, 0) + len(own)
                for lo, hi in slabs(own):
                    total += np.bincount(grams(own[lo:hi])[0].ravel(), minlength=BINS)
        for g, total in held.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([g] * (len(at) + 1), pa.string()), pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(total[at], docs_of[g]), pa.int64())], ["lang", "bin", "n"]
            )

    seen = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    return seen.mapInArrow(run, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))


def train(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log-probabilities (languages, bins) and log priors. What reaches the
    driver is languages x bins numbers, whatever the size of the input."""
    found = counts(docs.filter(crc_mod("doc_id", FOLDS) != HELD_OUT)).toPandas()
    langs = sorted(found["lang"].unique().tolist())
    table, prior = np.full((len(langs), BINS), 0.5), np.ones(len(langs))
    for k, g in enumerate(langs):
        own = found[found["lang"] == g]
        real = own["bin"] >= 0
        table[k, own["bin"][real]] += own["n"][real]
        prior[k] = own["n"][~real].sum()
    return langs, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32), np.log(prior / max(prior.sum(), 1))


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray]) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # languages x bins

    def run(batches):
        langs, table, prior = sent.value
        for b in batches:
            texts = b.column(2).to_pylist()
            best, score = np.full(len(texts), -1), np.zeros(len(texts))
            for lo, hi in slabs(texts) if langs else ():
                bins, starts, has = grams([t or "" for t in texts[lo:hi]])
                logp = np.empty((len(langs), hi - lo))
                for k in range(len(langs)):
                    row = table[k]
                    logp[k] = np.add.reduceat(row[bins[0]] + row[bins[1]] + row[bins[2]], starts, dtype=np.float64) + prior[k]
                p = np.exp(logp - logp.max(axis=0))
                p /= p.sum(axis=0)
                best[lo:hi] = np.where(has, p.argmax(axis=0), -1)
                score[lo:hi] = np.where(has, p.max(axis=0), 0.0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([langs[k] if k >= 0 else UNKNOWN for k in best], pa.string()), pa.array(score)], out.names)

    body = docs.select("doc_id", (crc_mod("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "text")
    out = T.StructType([*body.schema.fields[:2], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return body.mapInArrow(run, out)


def language_id(docs: DataFrame) -> DataFrame:
    return predict(docs, train(docs))
