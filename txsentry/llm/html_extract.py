"""Main text of web pages by a maximum-scoring run of tokens.

A page is a sequence of words and tags. Words score positive, tags negative, and one
linear scan finds the run with the highest sum: the densest stretch of text. The weights
are learnt from labelled pages: pages whose own markup names the main element
(``article``, ``main``, ``role=main``, ``itemprop=articleBody``).

- A context is an element's name, or one of the words in its class, id or role. Its
  weight is the log-odds that words below it are main text. A word scores the weight of
  its worst context; a whole element whose context counts against it (menus,
  adverts, footers, ...) is one negative token and gives no text, so an advert in the
  middle of an article costs a little and does not end the run.
- A tag scores minus the log-odds that it stands outside the main text, and at least a
  little below zero.

Contexts that no labelled page shows start from a list of usual names.

Defined cases: null or empty html, and pages without words, give the empty text; pages
cut off inside a tag lose that tag; stray end tags are ignored; character
references without a semicolon are decoded as browsers do; very long pages are read
whole in linear time; repeated rows get equal results; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE_PAGES = 20_000  # bound on the labelled pages that weights are learnt from
MAX_NAMES = 5_000
GONE = -0.5  # score of a whole element that is no main text
WORST, BEST = -6.0, 1.0

# Names that usually mark what is not the article.
_AWAY = """nav navbar navigation menu menubar sidebar aside footer header masthead banner topbar ad ads advert adverts advertisement
advertising adsense sponsor sponsored promo promotion cookie cookies consent notice alert newsletter subscribe subscription signup
social share sharing related recommended recommendations breadcrumb breadcrumbs pagination pager comment comments disqus reply
replies respond widget popup modal overlay toolbar login search skip form complementary contentinfo dialog copyright""".split()
_AWAY_TAGS = "nav footer header aside form script style noscript template head title iframe svg button select textarea menu dialog object canvas".split()
_BLOCKS = frozenset(
    """address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6
    head header hr html legend li main nav ol option p pre section summary table tbody td tfoot th thead title tr ul""".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template iframe svg textarea object canvas".split())
_PLAIN = frozenset("html body div span section table tbody tr td th article main a b i em strong u p ul ol li br h1 h2 h3 h4 h5 h6".split())
_MAIN = frozenset(("article", "main"))

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][\w:-]*)((?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>|<[!?/a-zA-Z][^>]*(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""([\w:-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_SPLIT = re.compile(r"[^a-z]+")
_SPACE = re.compile(r"\s+")


def _names(tag: str, attrs: str) -> tuple[tuple[str, ...], bool]:
    """Context names of an element, and whether its markup says it is the main text."""
    out, main = [], tag in _MAIN
    if tag not in _PLAIN:
        out.append(tag)
    for m in _ATTR.finditer(attrs):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "")
        if key in ("class", "id", "role"):
            out += ["." + w for w in _SPLIT.split(value.lower()) if w]
        if (key == "role" and value.lower() == "main") or (key == "itemprop" and "articleBody" in value):
            main = True
    return tuple(out), main


def tokens(page: str):
    """(kind, value, context, inside, away) in page order. Kinds: "w" text, "<" and ">"
    tags. ``context``: names of all open elements; ``inside``: in a marked main element."""
    stack: list[tuple[str, tuple, bool]] = []  # tag, names of it and all above, inside
    at, raw = 0, None
    context, inside = (), False
    for m in _TOKEN.finditer(page):
        tag = (m[2] or "").lower()
        if raw and not (m[1] and tag == raw):
            continue  # the text of scripts and the like is not looked at
        if m.start() > at and not raw:
            yield "w", page[at : m.start()], context, inside
        at, raw = m.end(), None
        if not tag:
            continue
        if m[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    yield ">", tag, *stack[i][1:]  # an end tag belongs to its element
                    del stack[i:]
                    context, inside = stack[-1][1:] if stack else ((), False)
                    break
            continue
        if tag in _BLOCKS:  # a block ends an open paragraph; an item ends the item before
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p" or (tag == "li" and stack[i][0] == "li"):
                    del stack[i:]
                    break
                if stack[i][0] in _BLOCKS:
                    break
            context, inside = stack[-1][1:] if stack else ((), False)
        own, main = _names(tag, m[3] or "")
        if tag == "header" and inside:
            own = own[1:]  # an article's own header is part of it
        if tag in _VOID:
            yield "<", tag, context, inside
            continue
        context, inside = context + own, inside or main
        stack.append((tag, context, inside))
        yield "<", tag, context, inside
        if tag in _RAW and not (m[3] or "").rstrip().endswith("/"):
            raw = tag
    if at < len(page) and not raw:
        yield "w", page[at:], context, inside


def prior() -> dict[str, float]:
    return {**{t: -3.0 for t in _AWAY_TAGS}, **{"." + w: -3.0 for w in _AWAY}}


def count(page: str, inner: Counter, outer: Counter) -> None:
    """Add a labelled page to the counts of words below a context and of tags."""
    usual = prior()
    for kind, value, context, inside in tokens(page):
        held = inner if inside else outer
        if kind == "w":
            if n := len(value.split()):
                for c in set(context):
                    held[c] += n
        elif not any(c in usual for c in context):
            held[kind + value] += 1


class Weights:
    def __init__(self, seen: dict[str, tuple[float, float]]):
        """``seen``: (inside, outside) counts by name."""
        self.context = prior()
        self.tag: dict[str, float] = {}
        for name, (a, b) in seen.items():
            odds = float(np.log((a + 0.5) / (b + 0.5)))
            if name[0] in "<>":
                self.tag[name] = min(-0.05, max(WORST, odds - 1))
            elif a + b >= 20:
                # a usual name needs evidence to count for the main text
                self.context[name] = min(BEST, max(WORST, odds - (2.0 if name in self.context else 0.0)))
        self.known: dict[tuple, float] = {}

    def of(self, context: tuple) -> float:
        w = self.known.get(context)
        if w is None:
            if len(self.known) > 50_000:
                self.known.clear()
            w = self.known[context] = min([self.context.get(c, BEST) for c in context], default=BEST)
        return w


def extract(page: str | None, weights: Weights) -> str:
    """The main text: blocks joined by an empty line."""
    total = top = 0.0
    start, best = 0, (0, 0)
    pieces: list[tuple[str, str]] = []  # text and tags that can be part of the run
    away = False
    for kind, value, context, _ in tokens(page or ""):
        w = weights.of(context)
        if w < 0:
            if not away:
                total += GONE
                away = True
            # its borders still part the blocks on both sides
            if kind != "w" and value in _BLOCKS:
                pieces.append((kind, value))
            elif kind == "w" and not value.isspace():
                pieces.append((kind, " "))
        else:
            away = False
            if kind == "w":
                total += w * len(value.split())
            else:
                total += weights.tag.get(kind + value, -0.05 if value in _PLAIN else -0.3)
            pieces.append((kind, value))
        if total <= 0:
            total, start = 0.0, len(pieces)
        elif total > top:
            top, best = total, (start, len(pieces))
    blocks, held = [], []
    for kind, value in [*pieces[best[0] : best[1]], ("<", "p")]:
        if kind == "w":
            held.append(html.unescape(value))
        elif value == "br":
            held.append(" ")
        elif value in _BLOCKS:
            if text := _SPACE.sub(" ", "".join(held)).strip():
                blocks.append(text)
            held = []
    return "\n\n".join(blocks)


def train(pages: DataFrame, bound: int = SAMPLE_PAGES) -> Weights:
    """Weights from at most about ``bound`` pages that mark their main element."""
    marked = pages.filter(F.col("html").rlike(r"(?i)<(article|main)[\s>]|role=.?main|itemprop=.?articleBody"))
    n = marked.count()
    share = F.lit(min(1.0, bound / max(n, 1)) * (1 << 20))
    picked = marked.filter(F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 20)) < share).select("html")

    def run(batches):
        inner, outer = Counter(), Counter()
        for b in batches:
            for page in b.column(0).to_pylist():
                count(page, inner, outer)
        names = sorted(set(inner) | set(outer))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *[pa.array([c[x] for x in names], pa.int64()) for c in (inner, outer)]], ["name", "a", "b"])

    seen = picked.mapInArrow(run, "name string, a long, b long").groupBy("name").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    top = seen.orderBy(F.desc(F.col("a") + F.col("b")), "name").limit(MAX_NAMES).collect()
    return Weights({r["name"]: (r["a"], r["b"]) for r in top})


def main_text(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars."""
    weights = weights or train(pages)
    sent = pages.sparkSession.sparkContext.broadcast((weights.context, weights.tag))  # MAX_NAMES at most

    def run(batches):
        weights = Weights({})
        weights.context, weights.tag = sent.value
        for b in batches:
            texts = [extract(t, weights) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], out.names)

    body = pages.select("page_id", "url", "html")
    out = T.StructType([*body.schema.fields[:2], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return body.mapInArrow(run, out)
