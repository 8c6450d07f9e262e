import html
import re

from tests.llm.conftest import SF
from txsentry.llm import html_extract as hx, queries

SHOP = """<html><head><title>T</title><style>p{x:"<p>"}</style></head><body><div class="menu"><a href=1>Home</a> <a>About us</a></div>
<div id="content"><h1>Big title</h1><p>First para with some <a href=x>link words</a> in it.</p>
<div class="ad">Buy now cheap stuff please today ok</div><p>Second &lt;b&gt; para&nbsp;&amp more.<br>Next  line</p><ul><li>one item<li>two item</ul></div>
<section class="comments"><p>nice post really great and lovely text here many words</p></section><footer>some words here</footer></body></html>"""
BLOG = """<body><header><h1>Site</h1></header><main><article><header><h1>T</h1></header><p>Short.</p><aside>side a b c d e f g</aside>
<p>End.<script>if (a < b) { x = "</p>" }</script></p><form>Name <input> x</form></article></main><div class="cookie-notice">We use cookies on this site ok accept all</div></body>"""


def weights(spark):
    return hx.train(spark.read.parquet(f"{SF}/pages.parquet"))


def test_query_against_marked_articles(spark):
    """The test pages mark their article, so a plain cut gives the expected text."""
    got = {r.page_id: r for r in queries.QUERIES["op3_html_text"](spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(pages)
    for r in pages:
        body = re.search(r"<article>(.*?)(</article>|<footer>|\Z)", r.html, re.S).group(1)
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"</?(?:br|b)>", " ", x))).strip() for x in re.split(r"</?(?:p|h1)>", body)]
        want = "\n\n".join(b for b in blocks if b)
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)


def test_pages_without_an_article_tag(spark):
    w = weights(spark)
    assert hx.extract(SHOP, w) == "Big title\n\nFirst para with some link words in it.\n\nSecond <b> para & more. Next line\n\none item\n\ntwo item"
    assert hx.extract(BLOG, w) == "T\n\nShort.\n\nEnd."


def test_edge_pages(spark):
    w = weights(spark)
    assert [hx.extract(p, w) for p in (None, "", "<br><p>", "plain words", "<p>cut <b", "a &am", "</div>x", "<!-- open")] == ["", "", "", "plain words", "cut", "a &am", "x", ""]
    long = "<article>" + "<p>some words here</p>" * 20000
    assert hx.extract(long, w).count("some") == 20000
    rows = [(1, "u", None), (1, "u", None), (None, None, "<article><p>x y</p></article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = hx.main_text(df).collect()
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in got) == [("1", "", 0), ("1", "", 0), ("None", "x y", 3)]
    assert hx.main_text(df.limit(0)).count() == 0
