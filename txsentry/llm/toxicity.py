"""Toxicity scores by weak supervision.

1. A bounded sample of training documents (``SAMPLE_DOCS``, chosen by a hash of the id)
   is written; near copies inside it count once.
2. Words and word beginnings whose document counts differ between labelled toxic and
   clean rows (likelihood ratio, Bonferroni bound) are mined. With the built-in word
   list they make up many voters: lexicon voters (groups of words), pattern voters
   (groups of word beginnings, signs of shouting and of address), voters for clean text
   (nothing found), and the annotator, whose vote is the row's label. A voter says toxic, clean or nothing.
3. A generative label model estimates each voter's class-conditional vote rates
   (accuracies) by EM without trusting any single voter, and the correlations that
   remain between voters within a class; correlated voters share their weight.
4. A logistic regression over the features' presence and density is trained on the model's posterior
   labels and scores every document.

Labels are learnt from the training rows only; label, language, source and id are never
inputs of a score.

Defined cases: null and empty texts get the score of a text without findings; a null id
belongs to the held-out part; labels without a toxic value are ignored and repeated labels
of an id count as toxic if one is; with no labels the built-in words alone decide; texts
of any length are read whole; repeated rows get equal scores; an empty table gives an
empty result; extra columns are ignored or kept (``keep``).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txsentry.llm.common import crc_mod, stage

FOLDS = 5
SAMPLE_DOCS = 40_000  # bound on the documents that the classifier is fitted on
MAX_FEATURES = 4_000
PREFIXES = (3, 4, 5, 6)
GROUPS = 6  # lexicon voters, and as many pattern voters
DENSE = 5.0
BALANCE = 5.0
TRUST = 1000.0
PRIOR_VOTES = 2.0  # a voter's first guess counts as so many votes

# Insults that a voter knows without any label.
LEXICON = (
    "idiot", "idiots", "moron", "morons", "stupid", "dumb", "loser", "losers", "pathetic", "worthless", "scum", "trash",
    "garbage", "disgusting", "clown", "fool", "imbecile", "jerk", "ugly", "vile", "filthy", "retard", "bastard", "hate",
)

_WORD = re.compile(r"[^\W\d_]+")
_SHOUT = re.compile(r"[A-Z]{4,}")
_ADDRESS = re.compile(r"\b(?:you|your|du|ihr|vous|toi|usted|eres)\b")
_STRESS = re.compile(r"[!?]{3,}|([a-z])\1{3,}")

TOXIC, CLEAN, NONE = 1, 0, 2


def _parts(word: str):
    """Feature names of a word: itself and its beginnings."""
    yield "=" + word
    for k in PREFIXES:
        if len(word) >= k:
            yield word[:k]


def _words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def _copy_key(text: str | None) -> int:
    """Smallest hash of three words in a row: equal for most near copies."""
    ws = (text or "").lower().split()
    return min((zlib.crc32(" ".join(ws[i : i + 3]).encode()) for i in range(max(1, len(ws) - 2))), default=0)


class Features:
    """The known features of a text and how dense they are; words are looked up once."""

    def __init__(self, names: list[str]):
        self.ids = {n: i for i, n in enumerate(names)}
        self.seen: dict[str, tuple] = {}

    def of(self, text: str | None) -> tuple[list[int], list[float], float]:
        """Ids of the features present, how many of 100 words have each (``DENSE`` at
        most), and the share of words with any."""
        seen, ids, out = self.seen, self.ids, {}
        counts = Counter(_WORD.findall((text or "").lower()))
        hits = 0
        for w, c in counts.items():
            hit = seen.get(w)
            if hit is None:
                if len(seen) > 300_000:
                    seen.clear()
                hit = seen[w] = tuple(ids[p] for p in _parts(w) if p in ids)
            if hit:
                hits += c
                for i in hit:
                    out[i] = out.get(i, 0) + c
        n = max(1, counts.total())
        found = sorted(out)
        return found, [min(DENSE, 100 * out[i] / n) for i in found], hits / n


def votes(text: str | None, found: list[int], share: float, names: list[str], label: int | None) -> bytes:
    """One vote per voter on a text with the features ``found``, in ``share`` of its words."""
    out = [NONE] * (2 * GROUPS)
    for i in found:
        n = names[i]
        out[zlib.crc32(n.encode()) % GROUPS + (0 if n[0] == "=" else GROUPS)] = TOXIC
    words = [i for i in found if names[i][0] == "="]
    raw = text or ""
    known = any(names[i][1:] in LEXICON for i in words)
    out += [
        TOXIC if known else NONE,
        CLEAN if not words else NONE,
        CLEAN if len(found) == len(words) else NONE,
        CLEAN if not found else NONE,
        TOXIC if share >= 0.01 else CLEAN if share < 0.003 else NONE,
        TOXIC if len(_SHOUT.findall(raw)) * 20 > len(raw) else NONE,
        TOXIC if _ADDRESS.search(raw.lower()) and found else NONE,
        TOXIC if _STRESS.search(raw) else NONE,
        NONE if label is None else TOXIC if label else CLEAN,
    ]
    return bytes(out)


class LabelModel:
    """A latent class with one vote table per voter and class. The votes of correlated
    voters are discounted: within a class, a voter's log-likelihood is divided by one
    plus the sum of its correlations with the other voters."""

    def __init__(self, n_voters: int, prior: float, annotator: int | None = None):
        """``annotator``: a voter that is trusted from the start (``TRUST`` votes, nearly
        all right) and whose votes are not discounted."""
        self.prior, self.share, self.annotator = prior, np.ones(n_voters), annotator
        # start: a vote is right more often than not
        self.start = np.array([[0.45, 0.10, 0.45], [0.10, 0.45, 0.45]])[:, None, :].repeat(n_voters, 1)
        self.votes = np.full(n_voters, PRIOR_VOTES)
        if annotator is not None:
            self.start[:, annotator] = [[0.5, 0.001, 0.499], [0.001, 0.5, 0.499]]
            self.votes[annotator] = TRUST
        self.table = self.start

    def posterior(self, v: np.ndarray) -> np.ndarray:
        """P(toxic) per row of votes."""
        logp = np.log(self.table)
        column = np.arange(v.shape[1])
        s = [(logp[y][column, v] * self.share).sum(axis=1) for y in (0, 1)]
        z = s[1] - s[0] + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def fit(self, v: np.ndarray, w: np.ndarray, rounds: int = 40) -> LabelModel:
        """EM over rows of votes ``v`` with weights ``w``."""
        said = np.stack([v == k for k in (0, 1, 2)], 2).astype(float)
        for _ in range(rounds):
            p = self.posterior(v)
            mass = np.stack([w * (1 - p), w * p])
            counts = np.einsum("yn,nvk->yvk", mass, said) + self.votes[:, None] * self.start
            self.table = counts / counts.sum(axis=2, keepdims=True)
            # no voter is worse than chance, which also keeps the classes from changing places
            t, c = self.table[:, :, TOXIC], self.table[:, :, CLEAN]
            t[1] = np.maximum(t[1], t[0])
            c[0] = np.maximum(c[0], c[1])
            self.table /= self.table.sum(axis=2, keepdims=True)
            self.prior = float(np.clip((mass[1].sum() + 1) / (w.sum() + 10), 0.005, 0.5))
            # correlations of speaking toxic within the classes
            x = said[:, :, 1] - said[:, :, 0]
            left = x - (1 - p)[:, None] * self._mean(0) - p[:, None] * self._mean(1)
            cov = (left * w[:, None]).T @ left / w.sum()
            dev = np.sqrt(np.diag(cov)) + 1e-6
            self.correlations = cov / np.outer(dev, dev)
            off = np.clip(self.correlations - np.eye(len(dev)), 0, 1)
            self.share = 1 / (1 + off.sum(axis=1))
            if self.annotator is not None:
                self.share[self.annotator] = 1.0
        return self

    def _mean(self, y: int) -> np.ndarray:
        return self.table[y, :, 1] - self.table[y, :, 0]

    @property
    def accuracies(self) -> np.ndarray:
        """P(a vote is right | the voter speaks)."""
        t = np.array([1 - self.prior, self.prior])[:, None, None] * self.table
        return (t[0, :, 0] + t[1, :, 1]) / (t[:, :, 0].sum(0) + t[:, :, 1].sum(0))


def fit_linear(rows: list[list[int]], dense: list[list[float]], p: np.ndarray, w: np.ndarray, n: int, l2: float = 2e-5, steps: int = 800) -> tuple[np.ndarray, float]:
    """Logistic regression of posterior labels on each feature's presence and density
    (Adam, full batch): 2 n weights and the bias. The rarer class counts up to ``BALANCE``
    times, so one clear finding can outweigh a low base rate."""
    mass = float((w * p).sum()), float((w * (1 - p)).sum())
    w = w * np.where(p >= 0.5, min(BALANCE, max(1.0, mass[1] / max(mass[0], 1e-9))), 1.0)
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    ids = np.fromiter((i for r in rows for i in r), np.int64, len(at))
    much = np.fromiter((x for r in dense for x in r), float, len(at))
    theta, m, s = np.zeros(2 * n + 1), np.zeros(2 * n + 1), np.zeros(2 * n + 1)
    total = w.sum()
    for t in range(1, steps + 1):
        z = theta[-1] + np.bincount(at, theta[ids] + theta[n + ids] * much, len(rows))
        err = w * (1 / (1 + np.exp(-z)) - p) / total
        g = np.concatenate((np.bincount(ids, err[at], n), np.bincount(ids, err[at] * much, n))) + l2 * theta[:-1]
        g = np.append(g, err.sum())
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        theta -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
    return theta[:-1], float(theta[-1])


def _sample(docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """(id, text, label) of at most about ``bound`` training documents: labelled ones
    first, unlabelled ones for the rest of the bound."""
    train = crc_mod("doc_id", FOLDS) != 0

    def picked(share: float) -> Column:
        return F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(min(1.0, share) * (1 << 20))

    # one row per labelled id that has documents, and how many
    ids = docs.filter(train).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    given = labels.filter(F.col("toxic").isNotNull() & train).groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").cast("int").alias("label"))
    known = stage(ids.join(given, F.col("doc_id") == F.col("_id")).select("doc_id", "label", "n"), "toxicity-labels")
    m = known.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    n = docs.filter(train).count()
    # both sides are bounded by ``bound``; Spark broadcasts the ids if they are small enough
    share = bound / max(m, 1)
    first = known.filter(picked(share)).select(F.col("doc_id").alias("_id"), "label")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).filter(train)
    sample = rows.filter(picked(share)).join(first, F.col("doc_id") == F.col("_id")).drop("_id")
    if m < min(n, bound):
        rest = rows.filter(picked((bound - m) / (n - m))).join(known.select("doc_id"), "doc_id", "left_anti")
        sample = sample.unionByName(rest.withColumn("label", F.lit(None).cast("int")))
    return sample.select(F.xxhash64("doc_id", "text").alias("id"), "text", "label")


def train(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE_DOCS) -> dict:
    """The fitted model: names, weights, bias, label_model."""
    rows = stage(_sample(docs, labels, bound), "toxicity-sample")

    def keys(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([_copy_key(t) for t in b.column(1).to_pylist()], pa.int64())], ["id", "label", "key"])

    copies = rows.select("id", "text", "label").mapInArrow(keys, "id long, label int, key long").toPandas()  # bounded by the sample
    one = frozenset(copies.groupby("key")["id"].min().tolist())

    def count(batches):
        held: dict[int, Counter] = {0: Counter(), 1: Counter()}

        def out():
            names = sorted(set(held[0]) | set(held[1]))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *[pa.array([held[y][n] for n in names], pa.int64()) for y in (0, 1)]], ["feature", "clean", "toxic"])
            held[0].clear()
            held[1].clear()

        for b in batches:
            for i, t, y in zip(*(c.to_pylist() for c in b.columns)):
                if i in one:
                    held[1 if y else 0].update({p for w in _words(t) for p in _parts(w)})
                    if len(held[0]) + len(held[1]) > 400_000:
                        yield from out()
        yield from out()

    labelled = rows.filter("label is not null")
    first = copies[copies["id"].isin(one) & copies["label"].notna()].drop_duplicates("id")
    n1, n0 = float((first["label"] > 0).sum()), float((first["label"] <= 0).sum())
    mined: list[str] = []
    plain: set[str] = set()
    if n1 and n0:
        found = labelled.select("id", "text", "label").mapInArrow(count, "feature string, clean long, toxic long")
        found = stage(found.groupBy("feature").agg(F.sum("clean").alias("b"), F.sum("toxic").alias("a")).filter("a + b >= 2"), "toxicity-features")
        tested = found.count()

        def term(seen, expected):
            return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

        a, b, df = F.col("a"), F.col("b"), F.col("a") + F.col("b")
        all_ = n1 + n0
        g2 = 2 * (term(a, df * n1 / all_) + term(b, df * n0 / all_) + term(n1 - a, (all_ - df) * n1 / all_) + term(n0 - b, (all_ - df) * n0 / all_))
        best = found.filter((a >= 2) & (a * n0 > 3 * b * n1)).withColumn("g2", g2).filter(F.col("g2") > 2 * float(np.log(tested + 2)))
        mined = [r["feature"] for r in best.orderBy(F.desc("g2"), "feature").limit(MAX_FEATURES).collect()]
        # a built-in word that labelled rows use like any other word is no insult here
        listed = found.filter(F.col("feature").isin(["=" + w for w in LEXICON]) & (a * n0 <= 3 * b * n1))
        plain = {r["feature"] for r in listed.select("feature").collect()}
    names = list(dict.fromkeys([*(f for w in LEXICON if (f := "=" + w) not in plain), *mined]))

    def look(batches):
        known = Features(names)
        for b in batches:
            ids, texts, labels_ = (c.to_pylist() for c in b.columns)
            found = [known.of(t) for t in texts]
            said = [votes(t, f, share, names, y) for t, (f, _, share), y in zip(texts, found, labels_)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(said, pa.binary()), pa.array([f for f, _, _ in found], pa.list_(pa.int32())), pa.array([d for _, d, _ in found], pa.list_(pa.float64()))],
                ["id", "votes", "found", "dense"],
            )

    seen = rows.mapInArrow(look, "id long, votes binary, found array<int>, dense array<double>").toPandas()  # bounded by the sample
    if not mined and not len(seen):
        return {"names": names, "weights": np.repeat([4.0, 0.0], len(names)), "bias": -3.0, "label_model": None}
    v = np.stack([np.frombuffer(x, np.uint8) for x in seen["votes"]]).astype(np.int64)
    w = np.where(seen["id"].isin(one), 1.0, 0.05)  # a near copy adds little
    model = LabelModel(v.shape[1], (n1 + 1) / (n1 + n0 + 10), v.shape[1] - 1).fit(v, w)
    weights, bias = fit_linear([list(x) for x in seen["found"]], [list(x) for x in seen["dense"]], model.posterior(v), w, len(names))
    return {"names": names, "weights": weights, "bias": bias, "label_model": model}


def score(docs: DataFrame, model: dict, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: doc_id) and held_out, score, predicted per row."""
    keep = keep or ["doc_id"]
    # MAX_FEATURES names and numbers at most
    sent = docs.sparkSession.sparkContext.broadcast((model["names"], model["weights"].tolist(), model["bias"]))
    width = len(keep) + 1

    def run(batches):
        names, weights, bias = sent.value
        known, weights, n = Features(names), np.array(weights), len(names)
        for b in batches:
            z = []
            for t in b.column(width).to_pylist():
                found, dense, _ = known.of(t)
                z.append(bias + weights[found].sum() + weights[n:][found] @ np.array(dense, float))
            z = np.array(z, float)
            p = 1 / (1 + np.exp(-z))
            yield pa.RecordBatch.from_arrays([*b.columns[:width], pa.array(p), pa.array((p >= 0.5).astype(np.int32))], [f.name for f in out.fields])

    body = docs.select(*keep, (crc_mod("doc_id", FOLDS) == 0).alias("held_out"), F.col("text").alias("_text"))
    out = T.StructType([*body.schema.fields[:width], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return body.mapInArrow(run, out)


def toxicity(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE_DOCS, keep: list[str] | None = None) -> DataFrame:
    return score(docs, train(docs, labels, bound), keep)
