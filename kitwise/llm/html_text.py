"""Main text of web pages by tag-path ratios.

The page is read as a sequence of text blocks, each with the path of elements
from the root to it. Blocks of one tag path (names and class words, not
positions) share statistics: text length, punctuation and link text, each per
node of the path. A path's content weight fuses the length ratio, the
punctuation ratio and the share of text outside links. Weights are smoothed
along the page, so that a short heading between long paragraphs is carried by
its neighbours, and paths whose smoothed weight reaches the threshold are
content paths. Content nodes are the blocks of content paths; the rest of
the block's container goes with them (a container is content if more of its
text is on content paths than not).

Elements that never hold article text by their meaning have ratio zero: menus,
page headers, footers, sidebars, notices, adverts, forms, reader comments,
scripts, styles (by element name, role, or a word of class and id). A word of
class and id doesn't count against the ratios: an element that holds most of the
text and punctuation of its article or page is a frame, whatever it is called.
Reader comments, and elements beside an article, are spared like that only if
nothing outside them is content. Inline text stays unless it is hidden. Nothing
is dropped or capped for its length.

Edge cases: a null or empty page, or one without content, has the empty text
(0 code points). Unclosed elements end with their parent, a page cut short is
read to its end, text without any element is one block. A quote that nothing
closes ends with its tag. Formulas and the text inside objects and canvases are
inline text. The work grows in proportion to the page, also with elements that
nothing closes and with any nesting. Repeated rows give
repeated results. Columns other than the given ones are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Smoothing over neighbouring blocks (Gaussian weights for distance 0, 1, 2).
SMOOTH = (1.0, 0.6, 0.14)
#: A content path's smoothed weight, as a share of the page's text-weighted mean.
THRESHOLD = 0.35

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg select".split())
#: Elements inside a block; all others begin and end blocks.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr img object canvas math mi mn mo ms mtext mrow mfrac msup msub msubsup msqrt"
    " mroot mover munder munderover mtable mtr mtd mstyle mpadded menclose semantics".split()
)
#: Elements that a new block element of the right kind closes.
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr"
    " main menu nav ol p pre section table ul".split()
)
SAME_ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
#: Elements that an end tag of something inside does not reach past.
SCOPE = frozenset("article main section aside nav header footer table ul ol div form body".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BOILER_TAGS = frozenset("nav footer aside form button dialog menu head".split())
BOILER_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar status".split()
)
BOILER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promoted promotion"
    " banner cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription"
    " signup login signin paywall nav navbar navigation menu menus breadcrumb breadcrumbs topbar masthead header footer"
    " foot copyright sidebar aside rail widget widgets related recommended recommendations trending popular share sharing"
    " social comment comments commentlist respond replies reply discussion disqus reader-comments form search pagination pager"
    " toolbar skip legal disclaimer tags toc".split()
)

#: Words of parts that can be longer than the article.
COMMENT_WORDS = frozenset("comment comments commentlist respond replies reply discussion disqus reader-comments".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/)?(?P<tag>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PUNCTUATION = re.compile(r"[.,;:!?…。，！？、؟]")
#: Class words that tell which parts a page has, not what the element is.
_ABOUT = re.compile(r"(?<![^\s])(?:has|no|with|without|hide|show)-\S+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)")
_WORD = re.compile(r"[A-Za-z][A-Za-z0-9]*")


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(text)} if text.strip() else {}


class _Element:
    """An open element. ``strong``: boilerplate by its name or role, ``weak``: by a word of its class or id.

    ``comments``: the weak words name reader comments. ``path`` numbers the tag path; ``boiler`` is settled when the page has been read.
    """

    __slots__ = (
        "article", "articles", "boiler", "comments", "depth", "good", "heading", "hidden", "in_article", "mass", "name", "named",
        "parent", "path", "rest", "strong", "taken", "weak",
    )

    def __init__(self, name: str, parent: _Element | None, attrs: dict[str, str], paths: dict[tuple[int, str], int]):
        self.name, self.parent = name, parent
        words = _WORD.findall(_ABOUT.sub("", (attrs.get("class", "") + " " + attrs.get("id", "")).lower()))
        mark = name + "".join(f".{w}" for w in attrs.get("class", "").lower().split())
        self.path = paths.setdefault((parent.path if parent else -1, mark), len(paths))
        self.depth = parent.depth + 1 if parent else 0
        inside = parent is not None and parent.in_article
        self.in_article = inside or name in ("article", "main")
        self.article: _Element | None = self if name in ("article", "main") else parent.article if parent else None
        self.articles = int(self.article is self)  # within it
        named = name not in ("html", "body", "main", "article") and name not in HEADINGS
        # an article's own header: its headings count, the rest doesn't
        own_header = inside and (name == "header" or (named and "header" in words))
        self.heading = own_header or (parent is not None and parent.heading)
        self.hidden = "hidden" in attrs or _HIDDEN.search(attrs.get("style", "").lower()) is not None
        self.strong = (
            self.hidden
            or name in BOILER_TAGS
            or (name == "header" and not own_header)
            or attrs.get("role", "").lower() in BOILER_ROLES
        )
        self.weak = named and any(w in BOILER_WORDS and not (own_header and w == "header") for w in words)
        self.comments = self.weak and any(w in COMMENT_WORDS for w in words)
        self.boiler, self.good, self.rest, self.taken, self.mass = False, 0, 0, False, 0.0
        self.named: _Element | None = None


class Block:
    """A piece of text with its element and the length of its link text."""

    __slots__ = ("element", "link", "text")

    def __init__(self, element: _Element, text: str, link: int):
        self.element, self.text, self.link = element, text, link


class _Ends:
    """Where inline elements of a page end, by one pass over the tags of each name."""

    def __init__(self, html: str):
        self.html = html
        self.tags: dict[str, tuple[list[int], list[int], list[int]]] = {}

    def _scan(self, tag: str) -> tuple[list[int], list[int], list[int]]:
        starts, ends, depths = [], [], []
        depth = 0
        for m in re.compile(rf"<(/?){re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).finditer(self.html):
            depth += -1 if m[1] else 1
            starts.append(m.start())
            ends.append(m.end())
            depths.append(depth)
        # for each tag the first one from there that leaves a lower depth than there was before it
        lower, waiting = [len(starts)] * len(starts), []
        for i, d in enumerate(depths):
            before = depths[i - 1] if i else 0
            waiting.append((before, i))
            while waiting and waiting[-1][0] > d:
                lower[waiting.pop()[1]] = i
        return starts, ends, lower

    def past(self, at: int, tag: str) -> int:
        """Where the element ``tag`` that is open at ``at`` ends; ``at`` if it doesn't."""
        if tag not in self.tags:
            self.tags[tag] = self._scan(tag)
        starts, ends, lower = self.tags[tag]
        i = bisect_left(starts, at)
        return ends[lower[i]] if i < len(starts) and lower[i] < len(starts) else at


class _Open:
    """The open elements: the innermost one, and all by name, so that tags find theirs without climbing."""

    def __init__(self, root: _Element):
        self.root = self.here = root
        self.by_name: dict[str, list[_Element]] = defaultdict(list)
        self.scopes: list[_Element] = []

    def push(self, e: _Element) -> None:
        self.here = e
        self.by_name[e.name].append(e)
        if e.name in SCOPE:
            self.scopes.append(e)

    def close(self, e: _Element) -> None:
        """Close ``e`` and what is open inside it."""
        while self.here.depth >= e.depth:
            self.by_name[self.here.name].pop()
            if self.here.name in SCOPE:
                self.scopes.pop()
            self.here = self.here.parent or self.root

    def ended(self, tag: str) -> _Element | None:
        """The element that an end tag closes."""
        e = self.by_name[tag][-1] if self.by_name[tag] else None
        beyond = e is not None and tag not in SCOPE and self.scopes and self.scopes[-1].depth > e.depth
        return None if beyond else e

    def outermost(self, names: set[str]) -> _Element | None:
        """The outermost open element of these names inside the last scope."""
        floor = self.scopes[-1].depth if self.scopes else 0
        found = []
        for name in names:
            line = self.by_name[name]
            i = bisect_right(line, floor, key=lambda e: e.depth)
            found += line[i : i + 1]
        return min(found, key=lambda e: e.depth, default=None)


def blocks(html: str) -> tuple[list[Block], list[_Element]]:
    """The text blocks of a page in order (white space collapsed, references decoded), and its elements, parents first."""
    out: list[Block] = []
    parts: list[str] = []
    link = 0
    paths: dict[tuple[int, str], int] = {}
    root = _Element("", None, {}, paths)
    elements = [root]
    line, owner = _Open(root), root
    hidden = _Ends(html)
    at, n = 0, len(html)
    in_link = 0

    def flush() -> None:
        nonlocal link
        text = " ".join("".join(parts).split())
        if text:
            out.append(Block(owner, text, min(link, len(text))))
        parts.clear()
        link = 0

    while at < n:
        m = _TOKEN.search(html, at)
        text = html[at : m.start() if m else n]
        if text:
            if not parts:
                owner = line.here
            decoded = unescape(text)
            parts.append(decoded)
            if in_link:
                link += len(decoded.strip())
        if not m:
            break
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                parts.append(m[0][9:].removesuffix("]]>"))
            continue
        if m["end"]:
            if tag in INLINE:
                in_link -= tag == "a" and in_link > 0
                continue
            flush()
            e = line.ended(tag)
            if e is not None:
                line.close(e)
                in_link = 0
            continue
        if tag in RAW and not m["attrs"].rstrip().endswith("/"):
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            at = close.end() if close else n
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in INLINE:
            in_link += tag == "a"
            if tag not in VOID and m["attrs"].strip():
                e = _Element(tag, line.here, _attributes(m["attrs"]), paths)
                if e.hidden:
                    at = hidden.past(at, tag)
                    in_link -= tag == "a" and in_link > 0
            continue
        flush()
        if tag in VOID:
            continue
        if tag in CLOSES_P or tag in SAME_ENDS:
            ends = SAME_ENDS.get(tag, set()) | ({"p"} if tag in CLOSES_P else set())
            e = line.outermost(ends)
            if e is not None:
                line.close(e)
        if tag == "body":
            while line.here.name == "head":
                line.close(line.here)
        e = _Element(tag, line.here, _attributes(m["attrs"]), paths)
        in_link = 0
        elements.append(e)
        line.push(e)
        if m["attrs"].rstrip().endswith("/"):
            line.close(e)
    flush()
    for e in reversed(elements):
        if e.parent is not None:
            e.parent.articles += e.articles
    for e in elements:
        if root.articles and e.articles == root.articles:  # a layout frame around every article, whose class names one of its parts
            e.weak = False
    _spare(out, elements)
    for e in elements:
        e.boiler = e.strong or e.weak or (e.parent is not None and e.parent.boiler)
    return out, elements


def _spare(page: list[Block], elements: list[_Element]) -> None:
    """Elements that hold most of their article's or page's text by the path ratios are not boilerplate for their class."""
    if not any(e.weak for e in elements):
        return
    for e in elements:  # parents first
        e.boiler = e.strong or (e.parent is not None and e.parent.boiler)
    own = [b for b in page if not b.element.boiler]
    weight = path_weights(own)
    for b in own:
        b.element.mass += len(b.text) * weight[b.element.path] ** 0.5
    for e in reversed(elements):
        if e.parent is not None:
            e.parent.mass += e.mass
    root = elements[0]
    least = THRESHOLD * root.mass / max(1, sum(len(b.text) for b in own))
    content_blocks = [b for b in own if weight[b.element.path] > 0 and weight[b.element.path] ** 0.5 >= least]

    # blocks under no part by name, and those that are free of one when the innermost is spared (outer ones are settled first)
    for e in elements:
        e.named = e if e.weak else e.parent.named if e.parent else None
    under: dict[int, int] = defaultdict(int)
    for b in content_blocks:
        under[id(b.element.named)] += 1
    has_article = any(b.element.in_article and b.element.named is None for b in content_blocks)
    free = under[id(None)]
    for e in elements:
        e.boiler = e.strong or (e.parent is not None and e.parent.boiler)
        if e.weak and not e.boiler and e.mass > 0:
            scope = e.parent.article or root
            if e.mass > scope.mass / 2 and not ((e.comments or (has_article and not e.in_article)) and free):
                e.weak = False
                free += under[id(e)]
        e.boiler = e.boiler or e.weak


def path_weights(page: list[Block]) -> dict[int, float]:
    """The fused ratio of each tag path: text and punctuation per node, less link text."""
    nodes: dict[int, int] = defaultdict(int)
    length: dict[int, int] = defaultdict(int)
    points: dict[int, int] = defaultdict(int)
    links: dict[int, int] = defaultdict(int)
    for b in page:
        p = b.element.path
        nodes[p] += 1
        length[p] += len(b.text)
        points[p] += len(_PUNCTUATION.findall(b.text))
        links[p] += b.link
    return {p: length[p] / n * (1 + points[p] / n) ** 0.5 * (1 - links[p] / length[p]) for p, n in nodes.items()}


def content(page: list[Block], elements: list[_Element]) -> list[Block]:
    """The content nodes of a page."""
    own = [b for b in page if not b.element.boiler]
    if not own:
        return []
    weight = path_weights(own)
    raw = [weight[b.element.path] ** 0.5 for b in own]
    smooth = []
    for i in range(len(own)):
        total = share = 0.0
        for j in range(max(0, i - 2), min(len(own), i + 3)):
            g = SMOOTH[abs(i - j)]
            total, share = total + g * raw[j], share + g
        smooth.append(total / share)
    best: dict[int, float] = defaultdict(float)
    for b, s in zip(own, smooth, strict=True):
        best[b.element.path] = max(best[b.element.path], s)
    mean = sum(len(b.text) * s for b, s in zip(own, smooth, strict=True)) / sum(len(b.text) for b in own)
    chosen = {p for p, s in best.items() if s >= THRESHOLD * mean and weight[p] > 0}
    # containers: text on content paths against the rest, from the leaves up, then down again
    for b in own:
        if b.element.path in chosen:
            b.element.good += len(b.text)
        else:
            b.element.rest += len(b.text)
    for e in reversed(elements):
        if e.parent is not None:
            e.parent.good += e.good
            e.parent.rest += e.rest
    for e in elements:
        container = e.name not in ("", "html", "body") and e.good > e.rest
        e.taken = container or (e.parent is not None and e.parent.taken)
    out = []
    for b in own:
        e = b.element
        if e.heading and e.name not in HEADINGS:
            continue
        if e.path in chosen or not chosen or (e.taken and (weight[e.path] > 0 or e.in_article)):
            out.append(b)
    return out


def main_text(html: str | None) -> str:
    """The article's blocks in page order, one a line."""
    return "\n".join(b.text for b in content(*blocks(html or "")))


def _extract(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        text = [main_text(h) for h in part["html"]]
        yield part[["page_id", "url"]].assign(text=text, n_chars=[len(t) for t in text])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) for each row of ``pages``."""
    id_type = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    out = rows.mapInPandas(_extract, f"page_id {id_type}, url string, text string, n_chars long")
    return out.withColumnsRenamed({"page_id": id_col, "url": url_col})
