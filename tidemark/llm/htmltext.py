"""Main text of web pages by the maximum-scoring subsequence of words and tags.

A page is read once into a sequence of words and tags. Words score positive (words of links
less, or negative), tags negative, and the best contiguous run, found in one linear scan, is
the content region. All weights come from labelled pages (``labelled_pages.PAGES``, or the
caller's own): what share of a tag's occurrences lies outside the article, how often the
article ends at it, and which element names and class or id words hold no article words.
Elements learned to hold none (menus, asides, adverts, forms, comments ...) and lists that
are little but links leave the sequence before the scan at a small fixed cost, so that an
advert in the middle does not cut the article in two, and give no text; tags are weighed by
what stays. A region inside an ``article`` element grows to the whole of it. Elements that hold the page's ``article``
or ``main`` stay whatever they are called, and headings of a ``header`` inside an article stay.

Text: character references are decoded, white space inside a block (``br`` and table cells
included) becomes one space, blocks are trimmed and joined in page order by one newline.

Edge cases: null and empty pages, and pages without article words, give the empty text;
broken markup (unclosed tags, comments and quotes, stray ``<``) is read to the end in linear
time, in the manner of browsers; very long pages are used whole; repeated rows are judged
alike; an empty table gives an empty result; other columns are not read (``carry`` names
those to hand on).
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, table
from tidemark.llm.labelled_pages import PAGES

# -- fixed values: element names of the HTML standard
RAW = {"script", "style", "title", "textarea", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
BLOCKS = HEADINGS | {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "footer", "form", "head", "header", "hgroup", "hr", "html", "legend", "li", "main",
    "menu", "nav", "ol", "optgroup", "option", "p", "pre", "search", "section", "select", "summary", "table", "tbody", "tfoot",
    "thead", "tr", "ul",
}
SPACES = {"br", "td", "th"}  # white space inside a block
CLOSED_BY_NEXT = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "option": {"select"}, "p": set()}

#: Elements that may leave by name alone, if labelled pages say so.
CUTTING = {"<nav>", "<aside>", "<header>", "<footer>", "<form>", "<button>", "<select>", "<dialog>", "<noscript>"}
LEAST_COST = 0.05  # of any tag
EDGE_COST = 20.0  # times the share of a tag's occurrences at the article's edge
CUT_COST = 2.0  # of an element that leaves the sequence
CUT_BELOW = 0.25  # share of article words (smoothed) below which an element leaves
LINK_SHARE = 0.8  # of a list's words
NEGATED = {"no", "not", "non", "has", "with", "without", "free"}
ARTICLE_WORDS = {"article", "post", "entry", "story"}

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_QUOTE = re.compile(r"=\s*([\"'])")
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def name_words(tag: str) -> list[str]:
    """Words of an element's class, id and role, singular and in lower case."""
    out: list[str] = []
    for m in _ATTRIBUTE.finditer(tag):
        before = ""
        for w in _WORDS.findall(m[2] or m[3] or m[4] or ""):
            w = w.lower()
            w = w[:-1] if len(w) > 2 and w.endswith("s") and not w.endswith("ss") else w
            if before not in NEGATED:
                out.append(w)
            before = w
    return out


def pieces(page: str) -> Iterator[tuple[str, str, str]]:
    """("text", text, ""), ("open", name, whole tag) and ("close", name, "") in page order."""
    at, n = 0, len(page)
    gone: set[str] = set()  # quotes that do not occur any more
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            yield "text", page[at:], ""
            return
        if lt > at:
            yield "text", page[at:lt], ""
        c = page[lt + 1 : lt + 2]
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 2)
            at = n if end < 0 else end + 3
        elif c in ("!", "?") or (c == "/" and not page[lt + 2 : lt + 3].isalpha()):
            end = page.find(">", lt + 2)
            at = n if end < 0 else end + 1
        elif c == "/" or (c.isascii() and c.isalpha()):
            m = _NAME.match(page, lt)
            if m is None:
                yield "text", "<", ""
                at = lt + 1
                continue
            name, at = m[1].lower(), _tag_end(page, m.end(), gone)
            if at > n:  # the page ends inside the tag
                return
            if c == "/":
                yield "close", name, ""
                continue
            yield "open", name, page[lt:at]
            if name in RAW:
                end = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(page, at)
                if end is None:
                    return
                at = end.start()
        else:
            yield "text", "<", ""
            at = lt + 1


def _tag_end(page: str, at: int, gone: set[str]) -> int:
    """Place after a tag's ``>``, which quoted attribute values may hold; beyond the page if there is none."""
    end = page.find(">", at)
    while end >= 0:
        q = _QUOTE.search(page, at, end)
        if q is None or q[1] in gone:
            return end + 1
        close = page.find(q[1], q.end())
        if close < 0:
            gone.add(q[1])
            return end + 1
        at = close + 1
        if close > end:
            end = page.find(">", at)
    return len(page) + 1


@dataclass
class Weights:
    """What labelled pages say: costs of tags, article shares of names, value of a link's word."""

    tag: dict[tuple[str, str], float] = field(default_factory=dict)
    share: dict[str, float] = field(default_factory=dict)
    link: float = 0.0
    known: dict[str, tuple[bool, bool]] = field(default_factory=dict)  # tags judged before

    def cost(self, kind: str, name: str) -> float:
        return self.tag.get((kind, name), 0.5)

    def judged(self, name: str, tag: str) -> tuple[bool, bool]:
        """(holds no article, is the header of an article) for an opening tag."""
        got = self.known.get(tag)
        if got is None:
            got = self._judge(name, tag)
            if len(tag) < 200 and len(self.known) < 10_000:
                self.known[tag] = got
        return got

    def _judge(self, name: str, tag: str) -> tuple[bool, bool]:
        if name in ("html", "body", "main") or name in HEADINGS:
            return False, False
        words = name_words(tag)
        bad = [f for f in (f"<{name}>", *words) if self.share.get(f, 1.0) < CUT_BELOW]
        if name == "article":  # readers' comments are often articles of their own
            bad = [f for f in bad if f not in ("<article>", "widget")]
        head = bool(bad) and all(f in ("<header>", "header") for f in bad)
        return bool(bad), head and (name == "header" or bool(ARTICLE_WORDS & set(words)))


class Page:
    """One page as a scored sequence with the elements that may leave it."""

    def __init__(self, page: str, weights: Weights):
        self.kind: list[str] = []  # text, open, close
        self.what: list[str] = []  # the text, or the element's name
        self.words: list[int] = []
        self.linked: list[bool] = []
        #: (first, last, element, holds no article, is an article's header, inside an article)
        self.elements: list[tuple[int, int, str, bool, bool, bool]] = []
        self._read(page, weights)

    def _read(self, page: str, weights: Weights) -> None:
        stack: list[list] = []  # [name, first, bad, head, in article, holds one]
        open_now: Counter[str] = Counter()
        links = 0

        def close_top(by_itself: bool = False) -> None:
            nonlocal links
            name, first, bad, head, inside, _ = stack.pop()
            open_now[name] -= 1
            links -= name == "a"
            if bad or name in ("ul", "ol", "dl", "article"):
                self.elements.append((first, len(self.kind) - (not by_itself), name, bad, head, inside))

        for kind, what, tag in pieces(page):
            if kind == "open":
                if what in BLOCKS and open_now["p"]:  # a block ends an open paragraph
                    k = len(stack) - 1
                    while stack[k][0] not in BLOCKS:
                        k -= 1
                    if stack[k][0] == "p":
                        while len(stack) > k:
                            close_top()
                if open_now[what] and what in CLOSED_BY_NEXT and what != "p":
                    k = len(stack) - 1
                    while stack[k][0] != what and stack[k][0] not in CLOSED_BY_NEXT[what]:
                        k -= 1
                    if stack[k][0] == what:
                        while len(stack) > k:
                            close_top()
                if what == "a" and open_now["a"] and stack[-1][0] == "a":
                    close_top()
            elif kind == "close":
                if what == "br":
                    kind = "open"
                elif open_now[what]:
                    if what in BLOCKS:
                        while stack[-1][0] != what:
                            close_top()
                        close_top(by_itself=True)
                    else:  # the end of an inline element closes no block
                        k = len(stack) - 1
                        while stack[k][0] != what and stack[k][0] not in BLOCKS:
                            k -= 1
                        if stack[k][0] == what:
                            while len(stack) > k + 1:
                                close_top()
                            close_top(by_itself=True)
            self.kind.append(kind)
            self.what.append(what)
            self.words.append(len(what.split()) if kind == "text" else 0)
            self.linked.append(links > 0)
            if kind == "open" and what not in VOID and not tag.endswith("/>"):
                bad, head = weights.judged(what, tag)
                if bad or what in BLOCKS or what == "a":
                    inside = bool(stack) and (stack[-1][4] or stack[-1][0] in ("article", "main"))
                    stack.append([what, len(self.kind) - 1, bad, head, inside, False])
                    open_now[what] += 1
                    links += what == "a"
                    if what in ("article", "main") and not bad:
                        for s in reversed(stack):  # what holds the article is not outside it
                            if s[5]:
                                break
                            s[2], s[5] = s[2] and s[0] in ("nav", "form", "aside", "footer"), True
        while stack:
            close_top()

    def leaving(self) -> list[tuple[int, int, bool]]:
        """Outermost elements that leave the sequence: (first, last, its headings stay)."""
        upto, linked = [0], [0]
        for w, in_link in zip(self.words, self.linked):
            upto.append(upto[-1] + w)
            linked.append(linked[-1] + (w if in_link else 0))
        out = []
        for first, last, name, bad, head, inside in self.elements:
            words = upto[last + 1] - upto[first]
            if not bad and name in ("ul", "ol", "dl") and words:
                bad = linked[last + 1] - linked[first] >= LINK_SHARE * words
            if bad and last > first:
                out.append((first, last, head and inside))
        out.sort(key=lambda x: (x[0], -x[1]))
        kept: list[tuple[int, int, bool]] = []
        for x in out:
            if kept and x[0] <= kept[-1][1] and not kept[-1][2]:
                continue
            kept.append(x)
        return kept

    def gone(self) -> tuple[list[bool], list[bool]]:
        """What leaves the sequence, and where a leaving element begins."""
        gone, edges = [False] * len(self.kind), [False] * len(self.kind)
        for first, last, headings in self.leaving():
            depth = 0
            for k in range(first, last + 1):
                if headings and self.what[k] in HEADINGS and self.kind[k] != "text":
                    depth = self.kind[k] == "open"
                    continue
                gone[k] = not depth
            edges[first] = True
        return gone, edges

    def text(self, weights: Weights) -> str:
        gone, edges = self.gone()
        first, last = self._region(weights, gone, edges)
        # a region inside an <article> is all of the article that stays
        around = [(a, b) for a, b, name, bad, _, _ in self.elements if name == "article" and not bad and a <= first and last <= b]
        first, last = max(around, default=(first, last))
        return self._blocks(first, last, gone)

    def _region(self, weights: Weights, gone: list[bool], edges: list[bool]) -> tuple[int, int]:
        """The best run of the sequence: the maximum-scoring subsequence, in one scan."""
        best, at, total, start = 0.0, (0, -1), 0.0, 0
        for k, kind in enumerate(self.kind):
            if gone[k]:
                s = -CUT_COST if edges[k] else 0.0
            elif kind == "text":
                s = self.words[k] * (weights.link if self.linked[k] else 1.0)
            else:
                s = -weights.cost(kind, self.what[k])
            if total <= 0:
                total, start = 0.0, k
            total += s
            if total > best:
                best, at = total, (start, k)
        return at

    def _blocks(self, first: int, last: int, gone: list[bool]) -> str:
        out: list[tuple[str, bool, int]] = []  # text, is a lesser heading, place of its last piece
        held: list[str] = []
        heading, end = False, 0

        def flush() -> None:
            nonlocal held
            if held and (t := " ".join("".join(held).split())):
                out.append((t, heading, end))
            held = []

        for k in range(first, last + 1):
            kind, what = self.kind[k], self.what[k]
            if kind == "text":
                if not gone[k]:
                    held.append(references.unescape(what) if "&" in what else what)
                    end = k
            elif what in BLOCKS:
                flush()
                heading = kind == "open" and what in HEADINGS and what != "h1"
            elif what in SPACES and not gone[k]:
                held.append(" ")
        flush()
        # a lesser heading at the very end, with a leaving element next, was that element's
        while len(out) > 1 and out[-1][1] and self._leads_out(out[-1][2], gone):
            out.pop()
        return "\n".join(t for t, _, _ in out)

    def _leads_out(self, at: int, gone: list[bool]) -> bool:
        for k in range(at + 1, len(self.kind)):
            if gone[k]:
                return True
            if self.words[k]:
                return False
        return False


def labelled(page: list[tuple[bool, str]]) -> Iterator[tuple[str, str, str, bool, bool]]:
    """The pieces of a labelled page, whether in the article, and whether next to its edge from outside."""
    whole = "".join(part for _, part in page)
    labels = [own for own, part in page for _ in part]
    first, last = labels.index(True), len(labels) - 1 - labels[::-1].index(True)
    at = 0
    for kind, what, tag in pieces(whole):
        raw = {"text": what, "open": tag}.get(kind, f"</{what}>")
        at = whole.index(raw, at)
        own, after = labels[at], at + len(raw)
        yield kind, what, tag, own, not own and (after == first or at == last + 1)
        at = after


def learn(pages: Iterable[list[tuple[bool, str]]] = PAGES) -> Weights:
    """Weights from labelled pages (fragments with their labels; a bounded set, on the driver)."""
    out, pages = Weights(), list(pages)
    held: Counter = Counter()  # (name word or <element>, words in the article?)
    linked: Counter = Counter()
    for page in pages:
        stack: list[tuple[str, list[str]]] = []
        for kind, what, tag, own, _ in labelled(page):
            if kind == "text":
                n = len(what.split())
                held.update({(f, own): n for f in {f for _, fs in stack for f in fs}})
                linked[own] += n * any(name == "a" for name, _ in stack)
            elif kind == "open" and what not in VOID:
                stack.append((what, [f"<{what}>", *name_words(tag)]))
            elif kind == "close" and any(name == what for name, _ in stack):
                while stack.pop()[0] != what:
                    pass
    for f in {f for f, _ in held}:
        if not f.startswith("<") or f in CUTTING:
            out.share[f] = (held[f, True] + 1) / (held[f, True] + held[f, False] + 4)
    out.link = 2 * (linked[True] + 1) / (linked.total() + 2) - 1
    # tags: only those that stay in the sequence
    tags: Counter = Counter()  # (kind, name, in the article)
    edge: Counter = Counter()
    for page in pages:
        gone, _ = Page("".join(part for _, part in page), out).gone()
        for (kind, what, _, own, at_edge), left in zip(labelled(page), gone):
            if kind != "text" and not left:
                tags[kind, what, own] += 1
                edge[kind, what] += at_edge
    for kind, name in {(k, n) for k, n, _ in tags}:
        inn, outside = tags[kind, name, True], tags[kind, name, False]
        out.tag[kind, name] = max(LEAST_COST, outside / (inn + outside + 1)) + EDGE_COST * edge[kind, name] / (inn + outside)
    return out


def main_text(page: str | None, weights: Weights) -> str:
    """The article's text of one page."""
    return Page(page, weights).text(weights) if page else ""


def extract(pages: DataFrame, carry: list[str], weights: Weights | None = None, column: str = "html") -> DataFrame:
    """The ``carry`` columns with text and n_chars: one row per page."""
    bounded_batches(pages.sparkSession)
    own = learn() if weights is None else weights
    rows = pages.select(F.struct(*carry).alias("doc"), F.coalesce(F.col(column), F.lit("")).alias("_page"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(k, 256) for k in range(0, len(whole), 256)):
                texts = [main_text(x.as_py(), own) for x in b.column("_page")]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["doc", "text", "n_chars"],
                )

    out = rows.mapInArrow(run, f"doc {rows.schema['doc'].dataType.simpleString()}, text string, n_chars long")
    return out.select(*[F.col("doc").getField(c).alias(c) for c in carry], "text", "n_chars")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages"), ["page_id", "url"])
