"""HTML extraction: pages of known text, broken markup, the scan against brute force."""

from __future__ import annotations

import html
import random
import re
import time

import pytest

from tests.conftest import SF_SMALL
from tidemark.llm import htmltext as h

WEIGHTS = h.learn()
PAGES = "page_id long, url string, html string"


def text(page):
    return h.main_text(page, WEIGHTS)


def wrapped(article: str, **more: str) -> str:
    around = {
        "before": '<header class="site"><a href="/">Site</a> tagline of the site</header><nav><a href="/a">One</a></nav>',
        "after": '<aside class="sidebar"><p>Popular stories that others read</p></aside><footer>(c) all rights</footer>',
        "open": "<article>",
        "close": "</article>",
    } | more
    return f"<!DOCTYPE html><html><head><title>t</title></head><body>{around['before']}{around['open']}{article}{around['close']}{around['after']}"


ARTICLE = "<h1>A title</h1><p>The first paragraph of it.</p><p>Short.</p><ul><li>one item</li><li>two</li></ul><p>End.</p>"
PLAIN = "A title\nThe first paragraph of it.\nShort.\none item\ntwo\nEnd."


@pytest.mark.parametrize(
    "box",
    [
        '<div class="advertisement"><p>Buy many things now, many more words than the article has, all of them long and loud</p></div>',
        '<form action="/s"><label>Mail address of yours</label><input name="m"><button>Subscribe to it</button></form>',
        '<aside><h3>Related</h3><p>Another story that is related</p></aside>',
        '<div id="cookieNotice">We use cookies on this page</div>',
        '<script>var a = "<p>not a text</p>";</script><style>p { margin: 0 }</style><!-- <p>nor this</p> -->',
        '<section class="comments"><article class="comment"><p>I think that this is a very long comment of a reader</p></article></section>',
        '<nav class="toc"><ol><li><a href="#1">First part</a></li></ol></nav>',
        '<ul class="social-share"><li><a href="#">Share this page</a></li></ul>',
        '<ul><li><a href="/1">Another page</a></li><li><a href="/2">One more page</a></li></ul>',
    ],
)
def test_boxes_inside_before_and_after_the_article_go(box):
    half = ARTICLE.replace("<p>Short.</p>", f"{box}<p>Short.</p>")
    for opened, closed in (("<article>", "</article>"), ("<main>", "</main>"), ('<div class="content">', "</div>")):
        assert text(wrapped(half, open=opened, close=closed)) == PLAIN
        assert text(wrapped(ARTICLE, open=box + opened, close=closed + box)) == PLAIN


def test_headers_of_articles_keep_headings_and_wrappers_stay():
    page = wrapped(
        '<header class="entry-header"><h1>A title</h1></header>' + ARTICLE.removeprefix("<h1>A title</h1>"),
        open='<div class="has-sidebar menu-page"><article class="post">',
        close="</article></div>",
    )
    assert text(page) == PLAIN
    # the heading of the comments goes with them
    assert text(wrapped(ARTICLE, open="<div>", close='<h3>Comments</h3><div class="comments"><p>first</p></div></div>')) == PLAIN


def test_references_and_white_space():
    page = wrapped("<p> a &lt;b&gt; &amp;amp; \n\t c&nbsp;d<br>e &#233;&#x41;&copy </p><table><tr><td>1</td><td>2</td></tr><tr><td>3</td></tr></table>")
    assert text(page) == "a <b> &amp; c d e éA©\n1 2\n3"


def test_broken_markup():
    assert text(wrapped("<p>one<b>two<p>three</article>four")) == "one two\nthree".replace("one two", "onetwo")
    assert text("plain text only") == "plain text only"
    assert text('<p>1 < 2 and <a title="x>y" href=>link</a> words <3 of it') == "1 < 2 and link words <3 of it"
    for page in (None, "", " \n", "<article></article>", "<!-- open", "<script>open", "<p", "<div class='ad'>only an advert", "<>", "</>"):
        assert text(page) in ("", "<>") , page


@pytest.mark.parametrize(
    "unit", ["<", '<a "', "<div>", "<b><p>", "<!--", '<a href="', "</div>", "<script>", '<div class="ad">', "<article>", "<a><ul>", "<article><header><h1>t</h1></header>"]
)
def test_long_pages_take_linear_time(unit):
    began = time.process_time()
    text(unit * (400_000 // len(unit)) + "x")
    assert time.process_time() - began < 20


def test_region_is_the_best_run():
    rng = random.Random(3)
    for _ in range(60):
        parts = "".join(rng.choice(["<p>", "</p>", "<div>", "</div>", "w " * rng.randrange(1, 9), "<a>", "</a>", "<li>", "<hr>"]) for _ in range(30))
        page = h.Page(parts, WEIGHTS)
        gone, edges = page.gone()
        score = [
            (-h.CUT_COST if edges[k] else 0.0)
            if gone[k]
            else page.words[k] * (WEIGHTS.link if page.linked[k] else 1.0)
            if kind == "text"
            else -WEIGHTS.cost(kind, page.what[k])
            for k, kind in enumerate(page.kind)
        ]
        first, last = page._region(WEIGHTS, gone, edges)
        best = max([0.0, *(sum(score[i : j + 1]) for i in range(len(score)) for j in range(i, len(score)))])
        assert sum(score[first : last + 1]) == pytest.approx(best)


def test_weights_come_from_the_labels():
    assert WEIGHTS.link < 0 and all(c > 0 for c in WEIGHTS.tag.values())
    own = h.learn([[(False, '<div class="zzz">gone</div>' * 5), (True, "<div class='kept'><p>words of the text</p></div>")]])
    assert own.share["zzz"] < h.CUT_BELOW < own.share["kept"]
    assert h.main_text('<div class="zzz">not this one</div><div class="kept">but this</div>', own) == "but this"


def plain_article(page: str | None) -> str:
    """The pages of the test tables hold their article in one <article> of p, h1 and br."""
    if not page or "<article>" not in page:
        return ""
    inner = page[page.index("<article>") + 9 : page.index("</article>")].replace("<br>", " ")
    blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner))
    return "\n".join(b for b in blocks if b)


def test_query_on_the_test_tables(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    want = sorted((r.page_id, r.url, plain_article(r.html), len(plain_article(r.html))) for r in pages.collect())
    assert sorted(map(tuple, h.query(spark, SF_SMALL).collect())) == want


def test_edge_cases(spark):
    assert h.extract(spark.createDataFrame([], PAGES), ["page_id"]).collect() == []
    rows = [(1, "u", None), (1, "u", None), (None, None, ""), (2, None, "<p>😀 a</p>")]
    df = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 AS text", "2 AS doc", "3 AS _page", "map(1, 2) AS m")
    got = sorted(map(tuple, h.extract(df, ["page_id", "url"]).collect()), key=str)
    assert got == sorted([(1, "u", "", 0), (1, "u", "", 0), (None, None, "", 0), (2, None, "😀 a", 3)], key=str)
