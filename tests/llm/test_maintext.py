"""Main text: the given pages against their article elements, the best run against all runs, awkward pages."""

import html
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from storeops.llm import maintext as m
from storeops.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def weights(spark):
    return m.fit(table(spark, SF, "pages"))


def article(page):
    """The text of the given pages, whose articles hold headings, paragraphs, bold words and breaks."""
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    return " ".join(html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"</?(?:h1|p|br)>", " ", body))).split())


def test_given_pages(spark):
    pages = dict(duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall())
    rows = m.op13_maintext(spark, SF).collect()
    assert {r.page_id: r.text for r in rows} == {i: article(p) for i, p in pages.items()}
    assert all(r.n_chars == len(r.text) > 0 for r in rows) and len(rows) == len(pages)


def test_best_run_is_the_best_of_all_runs():
    rng = random.Random(4)
    for _ in range(500):
        scores = [rng.choice([-4, -1, -0.5, 0.5, 1, 3]) for _ in range(rng.randint(0, 14))]
        sums = {(a, b): sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)}
        top = max(sums.values(), default=0)
        a, b = m.best_run(scores)
        assert sum(scores[a:b]) == max(top, 0) and ((a, b) == (0, 0)) == (top <= 0)


def test_weights(weights):
    assert weights.words["in"] > 0 > weights.words["out"] and all(w < 0 for w in weights.tags.values())
    assert weights.tags["p", "in"] > weights.tags["article", "out"]
    none = m.Weights.of({})
    assert none.words == {"in": m.WORD_DEFAULT, "out": m.OUTSIDE_DEFAULT, "plain": m.WORD_DEFAULT} and none.tags == {}


BODY = "<h1>The title</h1><p>First words of the text, and more.</p>{}<p>Last words, <b>bold</b>ly &amp; well&nbsp;said.\n So.</p>"
TEXT = "The title First words of the text, and more. Last words, boldly & well said. So."
CLUTTER = [
    '<nav><a href="/">Home of all things</a></nav>', "<header><p>Site name and a claim</p></header>", "<footer>All rights reserved by us</footer>",
    '<div class="sidebar"><p>Also on this site</p></div>', "<aside>Did you know this</aside>", '<div id="cookie-notice">We use cookies here</div>',
    '<div class="ad">Buy this thing <b>now</b></div>', "<form><label>Mail</label><input name=x><button>Send it</button></form>",
    "<script>var t = '</p><p>not text</p>';</script>", "<style>p{margin:0}</style>", "<!-- a comment <p>of words</p> -->",
    '<section id="comments"><h3>2 comments</h3><article class="comment"><p>Great post, thank you</p></article></section>',
    '<ul class="commentlist"><li>I do not think so at all</li></ul>', "<noscript>Turn scripts on please</noscript>", '<div role="search">Find</div>',
    "<div hidden>Hidden words</div>", "<select><option>One<option>Two</select>", '<div class="relatedPosts"><a href=x>More</a></div>',
]


@pytest.mark.parametrize("clutter", CLUTTER)
def test_clutter_goes_wherever_it_stands(weights, clutter):
    for page in (
        f"<html><body>{clutter}<article>{BODY.format('')}</article></body></html>",
        f"<html><body><article>{BODY.format('')}</article>{clutter}",
        f"<html><body><main><article>{BODY.format(clutter)}</article></main></body></html>",
        f"<body class='no-sidebar'><div id=content>{BODY.format(clutter)}</div>{clutter}",
        f"<main>{BODY.format('')}</main>{clutter}",
    ):
        assert m.main_text(page, weights) == TEXT, page


def test_loose_words_around_an_article_go(weights):
    page = f"<body><div>Some words that stand before</div><article>{BODY.format('')}</article><p>And after it</p></body>"
    assert m.main_text(page, weights) == TEXT
    links = "".join(f"<li><a href={i}>Link{i}</a>" for i in range(9))
    plain = m.main_text(f"<body><ul>{links}</ul><div>{BODY.format('')}</div><ul>{links}</ul>", m.Weights.of({}))
    assert plain == TEXT


def test_markup_faults(weights):
    cases = {
        "<p>x": "x", "": "", "<": "<", "a < b &lt; c": "a < b < c", "<article><p>open": "open", "<article><p>cut<b": "cut",
        '<article><p title=">">a</p>': "a", '<article><p title="open>a</p><p>b</p>': "a b", "<script>all": "", "<!-- all": "",
        "<article>one<br>two<wbr>three</article>": "one twothree", "<article><div class=ad><p>sold<h1>T</h1><p>text": "T text",
        "<ARTICLE><P>Upper</ARTICLE>": "Upper", "<article><p>a&#233;&eacute;&nosuch;</p></article>": "aéé&nosuch;",
    }
    for page, want in cases.items():
        assert m.main_text(page, weights) == want, page


def test_long_and_hostile_pages_take_linear_time(weights):
    words = " ".join(f"w{i}" for i in range(300_000))
    assert m.main_text(f"<article><p>{words}</article>", weights) == words
    for piece in ('<a "', "<div class=ad>", "<p>x", "<script>", "<div class=nav><h1>", "</p>", "<a '", "&amp"):
        m.main_text(piece * 60_000, weights)


def test_awkward_tables(spark, weights):
    rows = [(1, "u", f"<article>{BODY.format('')}"), (1, "u", f"<article>{BODY.format('')}"), (2, None, None), (None, "u", ""), (4, "u", " <p> </p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x")).withColumn("_html", F.lit("y"))
    got = sorted(((r.page_id or 0, r.text) for r in m.extract(pages, weights, ["page_id"]).collect()))
    assert got == [(0, ""), (1, TEXT), (1, TEXT), (2, ""), (4, "")]
    none = pages.limit(0)
    assert m.fit(none) == m.Weights.of({}) and m.extract(none, weights, ["page_id", "url"]).count() == 0
    assert m.extract(pages, m.fit(pages), ["page_id"]).where(F.col("text") == TEXT).count() == 2
