"""Hand-labelled pages the HTML extractor learns its weights from.

A page is a list of fragments in order, each with its label: True for the article, False
for everything else. Fragments need not be balanced; joined they are the page.
"""

from __future__ import annotations


def _box(tag: str, attrs: str, body: str) -> tuple[bool, str]:
    return False, f"<{tag}{' ' + attrs if attrs else ''}>{body}</{tag}>"


_LINKS = "<ul><li><a href='/'>Home</a></li><li><a href='/a'>About us</a></li><li><a href='/c'>Contact</a></li></ul>"
_PROSE = (
    "<p>The river rose all night and by morning the lower road was under water.</p>"
    "<p>Nobody in the <a href='/v'>village</a> had seen it so high, <b>not even</b> the old ferryman, who had kept count for "
    "<i>sixty</i> years.</p><p>They carried the seed corn to the church loft.</p>"
)
_LIST = "<ul><li>two sacks of rye from the upper barn</li><li>the tools, wrapped in oiled cloth</li></ul>"
_TABLE = "<table><tr><th>Year</th><th>Height</th></tr><tr><td>1921</td><td>three metres</td></tr></table>"

#: Names under which pages of all kinds keep what is not the article.
_MENUS = ["nav", "menu", "navbar", "navigation", "breadcrumb", "topbar", "toolbar", "pagination", "pager", "skip", "toc"]
_HEADS = ["header", "masthead", "logo", "branding", "hdr", "topnav"]
_FEET = ["footer", "copyright", "colophon", "legal", "ftr", "imprint", "contentinfo"]
_SIDES = ["sidebar", "widget", "aside", "related", "recommended", "recommendation", "teaser", "trending", "popular", "complementary", "rail"]
_NOTICES = ["notice", "cookie", "consent", "gdpr", "alert", "banner", "popup", "modal", "overlay", "toast", "disclaimer", "announcement", "paywall"]
_ADVERTS = ["ad", "advert", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "promoted", "adsbygoogle", "dfp", "outbrain", "taboola", "affiliate"]
_FORMS = ["form", "search", "login", "signin", "signup", "subscribe", "subscription", "newsletter", "register"]
_COMMENTS = ["comment", "respond", "reply", "replies", "disqus", "discussion", "feedback", "guestbook", "commentlist", "reader"]
_SHARING = ["share", "sharing", "social", "sharedaddy"]

_TALK = "<div><b>Anna</b> <a href='#'>Reply</a><p>I remember that flood well, we lost the hay and the whole lower field.</p></div>"
_ASK = "<label>Your name</label><input name='n'><button>Send it now</button>"
_SELL = "<a href='/buy'>Waterproof boots at half price</a> <p>Order today and save on every pair you buy.</p>"


def _named(names: list[str], body: str, tags: tuple[str, ...] = ("div", "section")) -> list[tuple[bool, str]]:
    """Every name once as a class and once as an id."""
    return [_box(tags[k % len(tags)], f'{("class", "id")[k % 2]}="{n}"', body) for n in names for k in (0, 1)]


PAGES: list[list[tuple[bool, str]]] = [
    # a news page with everything around an <article>
    [(False, "<html><body>"), _box("header", "", "<a href='/'>The Daily Gauge</a> <p>News from the river</p>"), _box("nav", "", _LINKS)]
    + _named(_MENUS, _LINKS)
    + _named(_HEADS, "<a href='/'>The Daily Gauge</a> <span>since 1921</span>")
    + [(False, "<article>"), (True, "<h1>The flood</h1>" + _PROSE), _box("aside", "", "<h3>Read more</h3>" + _LINKS)]
    + [(True, "<h2>After the water</h2>" + _LIST + _PROSE), (False, "</article>"), _box("aside", "", "<h3>Most read</h3>" + _LINKS)]
    + _named(_SIDES, "<h3>Read more</h3>" + _LINKS, ("div", "ul"))
    + [_box("footer", "", "<p>All rights reserved by the publisher.</p>" + _LINKS), (False, "</body></html>")],
    # a blog post in <main> with comments, forms and sharing links
    [(False, "<html><body>"), _box("header", "", "<h2>A quiet blog</h2>"), _box("nav", "", _LINKS), (False, "<main>")]
    + [(True, "<h1>What we saved</h1>" + _PROSE + _TABLE + "<blockquote>Water has no enemies, my father said.</blockquote>" + _PROSE)]
    + [(False, "</main>")]
    + _named(_SHARING, "<a href='#'>Share this page</a> <a href='#'>Send by mail</a>", ("div", "ul"))
    + _named(_COMMENTS, "<h3>Comments</h3>" + _TALK * 2, ("div", "section", "ol"))
    + [_box("form", "", _ASK + "<p>Write what you think about this page.</p>"), _box("button", "", "Load more of them")]
    + _named(_FORMS, "<p>Get the best stories by mail every week.</p>" + _ASK)
    + [_box("footer", "", "<p>Written by the river in the evenings.</p>"), (False, "</body></html>")],
    # a page of plain blocks; notices and adverts before, inside and after the text
    [(False, "<html><body>")]
    + _named(_NOTICES, "<p>We use small files to make this page work for you.</p><button>Accept them all</button>")
    + _named(_ADVERTS, _SELL, ("div", "section", "ins"))
    + [(True, "<div id='wrap'><div><h2>Notes on the flood</h2>" + _PROSE)]
    + [_box("div", "class='ad'", _SELL), (True, _PROSE + "<pre>gauge 1  3.1\ngauge 2  2.7</pre>" + _LIST + "</div></div>")]
    + _named(_FEET, "<p>All rights reserved by the publisher.</p>" + _LINKS)
    + [_box("dialog", "", "<p>Please confirm that you read our terms.</p>"), _box("noscript", "", "<p>Turn scripts on to see all of it.</p>")]
    + [_box("select", "", "<option>English</option><option>German</option>"), (False, "</body></html>")],
    # an article of plain blocks and sections, every line a block of its own
    [(False, "<html><body>"), _box("div", "id='header'", _LINKS)]
    + [(True, "<div><div>Sunday</div>" + "<div>The gauge stands at three metres.</div>" * 6 + "<section><h2>Monday</h2><div>Less.</div></section>" * 3)]
    + [(True, "<section><h3>Tuesday</h3><ul><li><span>rain</span></li></ul><div>Gone.</div></section></div>")]
    + [_box("div", "id='footer'", "<p>All rights reserved by the publisher.</p>"), (False, "</body></html>")],
    # bare markup: text directly in the body, links as the only menu
    [(False, "<body><a href='/'>Home</a> | <a href='/m'>Archive of all notes</a> | <a href='/x'>Next</a><hr>")]
    + [(True, "<h1>A short report</h1>" + _PROSE * 2 + "<p>Figures follow.</p>" + _TABLE + "<dl><dt>gauge</dt><dd>a marked post in the stream</dd></dl>")]
    + [(False, "<hr><a href='/'>Back to the start page</a> <a href='/m'>Archive of all notes</a></body>")],
]
