"""Main text of web pages.

The standard library's parser streams events over the whole page. Block elements cut the text into
lines; each line knows its text, how many tags stand in it, and the elements around it. The ratio
of text to tags per line is smoothed by a Gaussian, and lines above the threshold (the deviation of
the smoothed ratios) cluster into content. The clusters choose the content region: of the article and main
elements, the one that holds most clustered text, if it holds at least half as much as the lines outside
all of them (the mark counts double, and lines out of clusters a tenth); with it goes the rest of the main element around
an article. Else it is the innermost element around the clusters outside; where that is the page itself, from the
first to the last cluster and on over the paragraphs, headings and lists next to them.
Within the region all lines are kept, however short, but for those inside menus, headers, footers,
sidebars, notices, adverts, forms, scripts, styles and reader comments, known by element, role,
class or id. A class, an id or a form does not drop an article or main element inside it: that is a
region like others (after them among comments or related articles), as it often wraps the page. Of an
article's own names, and of names inside a region, only whole ones count: tags and categories stand there, and ids
made from headings. There an id alone drops only what readers wrote, a heading is never dropped, and a class that
may as well name a part of the text drops an element only if most of its text is in no cluster.

Text inside a dropped inline element goes alone; the rest of its line stays.

Defined cases: a null or empty page, or one without text, gives an empty text; a ``br`` is white
space inside its block; unclosed and stray tags are tolerated; repeated rows each give a row; other
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import picked, values

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
#: Elements that never hold the article's text.
DROPPED = frozenset(
    "head title nav footer aside script style noscript template iframe object embed svg canvas button select "
    "textarea dialog menu audio video map".split()
)
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar note status".split()
)
#: Words of a class or id that mark what is not the article.
DROPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense adslot adbox sponsor sponsored sponsors promo promos "
    "promotion banner banners cookie cookies cookiebar consent gdpr notice notices notification alert sidebar sidebars "
    "menu menus nav navbar navigation breadcrumb breadcrumbs masthead topbar footer comment comments commentlist "
    "discussion disqus reply replies respond share sharing sharebar social related recommended recommendations "
    "newsletter subscribe subscription signup login popup modal overlay widget widgets toolbar pagination pager "
    "copyright disclaimer skip paywall".split()
)
#: Those of them that mark other articles: by readers, or on something else.
OTHERS_NAMES = frozenset(
    "comment comments commentlist discussion disqus reply replies respond related recommended recommendations".split()
)
#: Those of them that may name a part of the text: inside a region they drop only what is mostly out of clusters.
DOUBTFUL_NAMES = frozenset("discussion social navigation disclaimer notice notices notification alert banner banners copyright".split())
DOUBTFUL_ROLES = frozenset("note status alert".split())
#: Those of them that drop a part of a region as an id alone.
ALONE_NAMES = frozenset("comments commentlist disqus respond".split())
#: How much more a cluster counts inside a marked region, and what a line outside the clusters counts.
MARKED, STRAY = 2.0, 0.1
#: In such a name those words tell about the page, not about the element: "has-sidebar".
ABOUT_PAGE = frozenset("has with no without is".split())
#: Names of elements that hold the article even when another word of the name is in the list above.
NEVER_BY_NAME = frozenset("html body main".split())
REGIONS = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks of running text: next to the article's, where it stands directly in the page, they are its too.
TEXT_BLOCKS = HEADINGS | frozenset("p li dt dd ul ol dl blockquote pre".split())
#: A paragraph ends where one of these begins.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split()
)
#: Elements no implied end tag reaches out of.
SCOPES = frozenset("html body main article section div aside nav header footer form td th li blockquote figure table dialog".split())
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
BROKEN_OFF = re.compile("<[A-Za-z/!?]")
SIGMA, REACH = 1.0, 2


def _dropped_words(value: str) -> set[str]:
    """The words of the names in ``value`` that mark what is not the article."""
    found = set()
    for name in value.split():
        words = [w.lower() for w in WORD.findall(name)]
        if ABOUT_PAGE.isdisjoint(words):
            found.update(DROPPED_NAMES.intersection(words))
    return found


def _dropped_names(value: str) -> set[str]:
    """The names in ``value`` that are such a word as a whole: tags and categories of an article are not."""
    return DROPPED_NAMES.intersection(value.lower().split())


class Element:
    """An open element: is its text dropped, is it in a page header, and which marked regions enclose it.

    ``regions`` holds at most a main and an article element; an article within an article belongs
    to the outer one. ``aside`` is dropped by name or as a form, up to a region inside that is
    rescued: ``rescued`` is the innermost such region, ``others`` tells that it stands among reader
    comments or related articles. ``doubt`` is the outermost element whose name may mark what is not the article.
    """

    __slots__ = ("tag", "parent", "depth", "dropped", "header", "regions", "aside", "rescued", "others", "doubt")

    def __init__(self, tag, parent, dropped, header):
        self.tag, self.parent, self.dropped, self.header = tag, parent, dropped, header
        self.depth = 0 if parent is None else parent.depth + 1
        self.regions = {} if parent is None else parent.regions
        self.aside = parent is not None and parent.aside
        self.rescued = None if parent is None else parent.rescued
        self.others = parent is not None and parent.others
        self.doubt = None if parent is None else parent.doubt

    def mark(self, kind: str):
        if kind not in self.regions:
            self.regions = {**self.regions, kind: self}

    def rescue(self, kind: str):
        """A region inside what is dropped by name or as a form is one of its own."""
        self.aside, self.rescued = False, self
        self.others = self.others and kind != "main"
        self.regions = {kind: self} if kind == "main" else {**self.regions, kind: self}

    def region(self):
        """The article, else the main element."""
        return self.regions.get("article") or self.regions.get("main")

    def block(self):
        """The innermost element that is not inline, or is a region."""
        element = self
        while element.tag in INLINE and element not in element.regions.values():
            element = element.parent
        return element

    def inside(self, other) -> bool:
        element = self
        while element.depth > other.depth:
            element = element.parent
        return element is other


class Lines(HTMLParser):
    """Streams a page into ``lines`` of text that is not dropped: (text, tags, the block's element)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("", None, False, False)
        self.stack, self.open = [self.root], Counter()
        self.pieces: list[str] = []
        self.tags, self.skipped = 0, False
        self.lines: list[tuple[str, int, Element]] = []

    def end_line(self):
        text = " ".join("".join(self.pieces).split())
        if text:
            self.lines.append((text, self.tags, self.stack[-1].block()))
        if text or self.skipped:
            self.tags, self.skipped = 0, False
        self.pieces.clear()

    def pop(self):
        self.open[self.stack.pop().tag] -= 1

    def close_to(self, tag: str):
        while self.stack[-1].tag != tag:
            self.pop()
        self.pop()

    def close_implied(self, tag: str):
        """Ends the innermost open ``tag`` unless a scope lies between."""
        if self.open[tag]:
            for element in reversed(self.stack):
                if element.tag == tag:
                    self.close_to(tag)
                    return
                if element.tag in SCOPES:
                    return

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in INLINE:
            if tag == "br":
                self.pieces.append(" ")
                return
        else:
            self.end_line()
        if tag in VOID:
            return
        if tag in ENDS_PARAGRAPH:
            self.close_implied("p")
        elif tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            self.close_implied(tag)
        attrs = dict(attrs)
        names = f"{attrs.get('class') or ''} {attrs.get('id') or ''}"
        role = (attrs.get("role") or "").lower()
        kind = tag if tag in REGIONS else role if role in REGIONS else "article" if attrs.get("itemprop") == "articleBody" else None
        within = bool(self.stack[-1].regions) and not kind
        doubt = set()
        if tag in NEVER_BY_NAME or (within and tag in HEADINGS):
            words = set()
        elif within:
            words = _dropped_names(attrs.get("class") or "") | ALONE_NAMES.intersection((attrs.get("id") or "").lower().split())
            doubt = DOUBTFUL_NAMES & words or DOUBTFUL_ROLES & {role}
            words -= doubt
        else:
            words = _dropped_names(names) if kind else _dropped_words(names)
        if tag in REGIONS and not words:
            self.close_unclosed()
        parent = self.stack[-1]
        hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in (attrs.get("style") or "").replace(" ", "").lower()
        by_role = role in DROPPED_ROLES and not (within and role in DOUBTFUL_ROLES)
        dropped = parent.dropped or tag in DROPPED or by_role or hidden or (tag == "header" and not parent.regions)
        header = parent.header or tag == "header"
        if header and parent.regions and not parent.dropped and tag not in DROPPED:
            dropped = dropped or not (tag in HEADINGS or tag in INLINE or tag in ("header", "div", "hgroup"))
        element = Element(tag, parent, dropped, header)
        element.aside = element.aside or tag == "form" or bool(words)
        element.doubt = element.doubt or (element if doubt else None)
        element.others = element.others or not OTHERS_NAMES.isdisjoint(words) or bool(kind and words)
        if kind and not dropped:
            if element.aside:
                element.rescue(kind)
            else:
                element.mark(kind)
        self.stack.append(element)
        self.open[tag] += 1

    def close_unclosed(self):
        """An article does not stand in a menu or header: one still open there was never closed."""
        for i, element in enumerate(self.stack):
            if element.tag in ("nav", "header", "head", "noscript") or (
                element.dropped and element.tag == "div" and not element.parent.dropped and self.open["div"] == 1
            ):
                while len(self.stack) > i:
                    self.pop()
                return

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag not in INLINE:
            self.end_line()
        if self.open[tag]:
            self.close_to(tag)

    def handle_data(self, data):
        if self.stack[-1].dropped or self.stack[-1].aside:
            self.skipped = self.skipped or not data.isspace()
        else:
            self.pieces.append(data)

    def done(self) -> list[tuple[str, int, Element]]:
        self.close()
        self.end_line()
        return self.lines


def smoothed_ratios(chars: np.ndarray, tags: np.ndarray) -> np.ndarray:
    """Characters of text per tag of each line, smoothed over its neighbours."""
    ratio = chars / np.maximum(tags, 1)
    kernel = np.exp(-np.arange(-REACH, REACH + 1) ** 2 / (2 * SIGMA**2))
    weight = np.convolve(np.ones(len(ratio)), kernel)[REACH:-REACH]
    return np.convolve(ratio, kernel)[REACH:-REACH] / weight


def _clustered(lines) -> tuple[np.ndarray, np.ndarray]:
    """Characters of each line, and whether it is above the threshold."""
    chars = np.array([len(x[0]) for x in lines], float)
    smooth = smoothed_ratios(chars, np.array([x[1] for x in lines], float))
    return chars, smooth >= min(smooth.std(), smooth.max())


def _doubtful(lines, chars: np.ndarray, content: np.ndarray) -> dict[Element | None, float]:
    """Of each element in doubt, by how many characters its text in clusters exceeds the rest of it."""
    found: dict[Element | None, float] = {}
    for line, n, clustered in zip(lines, chars, content):
        if line[2].doubt is not None:
            found[line[2].doubt] = found.get(line[2].doubt, 0) + (n if clustered else -n)
    return found


def main_text(html: str | None) -> str:
    """The article's lines, joined by newlines; empty if there is none."""
    html = html or ""
    # What follows the last ">" cannot end a tag; from a "<" on it is a tag that was broken off.
    end = html.rfind(">") + 1
    broken = BROKEN_OFF.search(html, end)
    parser = Lines()
    parser.feed(html[: broken.start()] if broken else html)
    # a page header inside the region keeps its headings only
    lines = [x for x in parser.done() if not (x[2].header and x[2].tag in ("header", "div", "hgroup"))]
    if not lines:
        return ""
    chars, content = _clustered(lines)

    weights: dict[Element | None, float] = {}
    for weight, line in zip(chars * np.where(content, 1.0, STRAY), lines):
        region = line[2].region()
        weights[region] = weights.get(region, 0) + weight
    plain = weights.pop(None, 0)
    # comments and related articles count where no other region is marked
    weights = {r: w for r, w in weights.items() if not r.others} or weights
    if weights:
        region = max(weights, key=weights.get)
        if MARKED * weights[region] >= plain:
            around = [region, region.regions.get("main")]
            kept = _doubtful(lines, chars, content)
            return "\n".join(x[0] for x in lines if kept.get(x[2].doubt, 0) >= 0 and any(
                r is not None and r in x[2].regions.values() and x[2].rescued is r.rescued for r in around
            ))
        lines = [x for x in lines if x[2].region() is None]
        content = _clustered(lines)[1]

    # No region is marked: the clusters only locate it, as the innermost element around them, which is
    # the one around the first and the last of them. Where that is the page itself, the paragraphs,
    # headings and list lines next to them belong to it.
    marked = np.flatnonzero(content)
    first, last = int(marked[0]), int(marked[-1])
    region = lines[first][2]
    while not lines[last][2].inside(region):
        region = region.parent

    whole_page = region.tag in ("", "html", "body")

    def belongs(element) -> bool:
        return element.tag in TEXT_BLOCKS if whole_page else element.inside(region)

    while first and belongs(lines[first - 1][2]):
        first -= 1
    while last + 1 < len(lines) and belongs(lines[last + 1][2]):
        last += 1
    return "\n".join(x[0] for x in lines[first : last + 1])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h) for h in values(batch.column("html"), 64)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html)."""
    pages = picked(pages, "page_id", "url", "html")
    kind = dict(pages.dtypes)
    return pages.mapInArrow(
        _extract, f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars long"
    )
