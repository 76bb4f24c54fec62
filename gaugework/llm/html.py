"""Main text of HTML pages by smoothed text-to-tag ratios.

The standard library's streaming parser gives events; block elements cut the
page into lines, and each line has its text, its number of tags and the
containers that it stands in. The ratio of text outside links to tags of each
line, ENOUGH at most, is smoothed with a Gaussian over the neighbouring lines,
and lines above the threshold (the standard deviation of the smoothed ratios,
half their mean at most) cluster into content. The clustered text, weighted by
its ratio, decides which elements are content: every outermost article or main
element that holds some, whole, with the elements nested in it, where these hold
at least a third of it; else the innermost container of all clusters, whole, or,
where that is the page itself, the run of clusters with the headings and
paragraphs around it.
Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments are left out by element, role or whole class name wherever they
stand; a form, or an element with the name of a place (sidebar, header), stays
where it holds a main element or most of the text of the page.

Defined results: a null or empty page has an empty text; unclosed elements end
with their container, unknown references stay as they are; repeated rows give
equal texts. Every page is handled alone, by any task, whole.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements whose text is never article text.
OUT = frozenset(
    "head title script style noscript template nav header footer aside form button select option textarea input label fieldset menu "
    "iframe object embed applet canvas svg math audio video dialog".split()
)
OUT_ROLE = frozenset("navigation banner contentinfo complementary search form menu menubar alert alertdialog dialog".split())
#: Names of a class or id that mark what is no article text, wherever it stands.
OUT_WORD = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox sponsor sponsored promo promotion cookie cookies consent gdpr notice notices notification "
    "alert popup breadcrumb breadcrumbs comment comments commentlist disqus reply replies share sharing social related recommended recommendations newsletter "
    "subscribe signup login pagination pager skip".split()
)
#: Names of places on a page, which also wrappers of the article have: an element of that name that holds most of the text stays.
PLACE_WORD = frozenset("banner modal overlay nav navbar navigation menu menus header masthead footer sidebar aside widget widgets search toolbar".split())
#: Words that make a compound name (site-header, cookie-notice, comment-list) with those above; any other word makes it something else (related-work).
FORM_WORD = frozenset("site main top bottom left right primary secondary global container wrapper wrap box bar block area list item items link links button buttons slot unit posts form".split())
#: Names that leave out an article element, and ids that leave out a section; another id of a section, or of a heading or paragraph, is an anchor.
OUT_ARTICLE = frozenset("ad ads advert advertisement sponsored comment comments reply related recommended teaser".split())
OUT_SECTION = frozenset("ad ads advert adverts comment comments commentlist disqus replies".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
ID_TAG = frozenset("center div dl ol table tbody td ul".split())
#: Elements that another one of the same kind, or a block, ends.
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("article aside blockquote body div dl fieldset figure footer form header html main menu nav ol section table ul".split())
REGION = frozenset(("article", "main"))
#: Elements of a head; any other one ends it, with or without an end tag.
HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
#: Elements that make a page's parts; others stand within a part's text.
PART = frozenset("html body center div main article section td table tbody tr".split())
SIGMA = 1.0
#: A line of so many characters a tag is text beyond doubt; more count no more, so that one long line does not lift the threshold.
ENOUGH = 80
#: Clustered text of an article or main element counts so many times against clustered text outside all of them.
REGION_WEIGHT = 2.0
SPLIT = re.compile(r"[^a-z0-9]+")


#: Verdicts on an element: its text stays, stays if it holds most of the page's, or is left out.
IN, PLACE, LEFT_OUT = 0, 1, 2


def _named(name: str, words: frozenset) -> bool:
    """Whether a whole name is one of the words, or made of them and words of form."""
    if name in words:
        return True
    parts = [x for x in SPLIT.split(name) if x and not x.isdigit()]
    return not words.isdisjoint(parts) and all(x in words or x in FORM_WORD or x in OUT_WORD or x in PLACE_WORD for x in parts)


def _verdict(tag: str, attrs: list) -> int:
    if tag == "form":
        return PLACE
    if tag in OUT:
        return LEFT_OUT
    if tag in ("html", "body", "main"):
        return IN
    found = IN
    for name, value in attrs:
        if not value:
            if name == "hidden":
                return LEFT_OUT
        elif name in ("class", "id") and tag not in HEADING:
            if tag == "article":
                out, place = OUT_ARTICLE, None
            elif name == "id" and tag not in ID_TAG:
                out, place = OUT_SECTION if tag == "section" else None, None
            else:
                out, place = OUT_WORD, PLACE_WORD
            for one in value.lower().split():
                if out and _named(one, out):
                    return LEFT_OUT
                if place and _named(one, place):
                    found = PLACE
        elif name == "role" and value.lower() in OUT_ROLE or name == "aria-hidden" and value.lower() == "true":
            return LEFT_OUT
    # Inside a line there is no wrapper.
    return LEFT_OUT if found == PLACE and tag not in BLOCK else found


@dataclass
class Line:
    text: str
    tags: int
    region: int | None  # number of the outermost article or main element, `None` outside all
    place: int | None  # number of the nearest PLACE element
    unlinked: int  # characters outside links
    node: int  # number of the element that it stands in


class Lines(HTMLParser):
    """Events to lines."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, int | None, int | None]] = []  # element, left out, region, place
        self.open = [0]  # numbers of the stack's elements, after that of the page
        self.nodes: list[tuple[str, int, int]] = [("html", 0, 0)]  # element, number of the one around it, depth
        self.lines: list[Line] = []
        self.places: list[int | None] = []  # the place around each
        self.holds_main: set[int] = set()
        self.text: list[str] = []
        self.tags = self.regions = self.links = self.linked = 0
        self.at: int | None = None
        self.place: int | None = None

    def cut(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.lines.append(Line(text, max(1, self.tags), self.at, self.place, max(0, len(text) - self.linked), self.open[-1]))
            self.tags = 0
        self.text, self.linked = [], 0

    def pop_to(self, k: int) -> None:
        if self.place != (self.stack[k - 1][3] if k else None):
            self.cut()
        self.links -= sum(name == "a" for name, *_ in self.stack[k:])
        del self.stack[k:], self.open[k + 1 :]
        self.at, self.place = self.stack[-1][2:] if self.stack else (None, None)

    def chain(self, place: int | None):
        """A place and those around it."""
        while place is not None:
            yield place
            place = self.places[place]

    def close_open(self, names: set | frozenset) -> None:
        """End the nearest of these elements inside the present container."""
        for k in range(len(self.stack) - 1, -1, -1):
            name = self.stack[k][0]
            if name in names:
                self.pop_to(k)
                return
            if name in SCOPE:
                return

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if self.stack and self.stack[-1][0] == "head" and tag not in HEAD:
            self.pop_to(len(self.stack) - 1)
        if tag in BLOCK:
            self.cut()
            self.close_open({"p"})
        elif tag == "br":
            self.text.append(" ")
        if tag in IMPLIED:
            self.close_open(IMPLIED[tag])
        if tag in VOID:
            return
        verdict = _verdict(tag, attrs)
        out = bool(self.stack and self.stack[-1][1]) or verdict == LEFT_OUT
        if not out and verdict == PLACE:
            self.places.append(self.place)
            self.place = len(self.places) - 1
        if tag in REGION or ("role", "main") in attrs:
            if self.at is None:
                self.regions += 1
                self.at = self.regions
            if not out and tag != "article":
                self.holds_main.update(self.chain(self.place))
        self.links += tag == "a"
        self.stack.append((tag, out, self.at, self.place))
        self.nodes.append((tag, self.open[-1], len(self.open)))
        self.open.append(len(self.nodes) - 1)

    def parse_comment(self, i, report=1):
        """A comment without an end takes the rest of the page."""
        k = super().parse_comment(i, report)
        return len(self.rawdata) if k < 0 else k

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BLOCK:
            self.cut()
        for k in range(len(self.stack) - 1, -1, -1):
            name = self.stack[k][0]
            if name == tag:
                self.pop_to(k)
                return
            if name in SCOPE and tag not in SCOPE:
                return

    def handle_data(self, data):
        if not (self.stack and self.stack[-1][1]):
            self.text.append(data)
            if self.links:
                self.linked += len(data.strip())


def smooth(values: list[float], sigma: float = SIGMA) -> list[float]:
    reach = math.ceil(3 * sigma)
    kernel = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(-reach, reach + 1)]
    out = []
    for i in range(len(values)):
        lo, hi = max(0, i - reach), min(len(values), i + reach + 1)
        weights = kernel[lo - i + reach : hi - i + reach]
        out.append(sum(w * v for w, v in zip(weights, values[lo:hi])) / sum(weights))
    return out


#: A tag that the end of the page cuts off, which is no text.
UNFINISHED = re.compile(r"<[A-Za-z/!?][^>]*\Z")


def parsed(page: str) -> Lines:
    parser = Lines()
    parser.feed(page)
    if UNFINISHED.match(parser.rawdata):
        parser.rawdata = ""
    parser.close()
    parser.cut()
    return parser


def clusters(lines: list[Line]) -> tuple[list[float], float, list[bool]]:
    """Ratio of each line, their smoothed mean, and which lines reach the threshold."""
    raw = [min(ENOUGH, x.unlinked / x.tags) for x in lines]
    ratios = smooth(raw)
    mean = sum(ratios) / len(ratios)
    threshold = math.sqrt(sum((x - mean) ** 2 for x in ratios) / len(ratios))
    threshold = min(threshold, mean / 2)
    return raw, mean, [x >= threshold for x in ratios]


def common(nodes: list[tuple[str, int, int]], some: list[int]) -> int:
    """The nearest part of the page around all of these elements."""
    at = some[0]
    for other in some[1:]:
        while at != other:
            if nodes[at][2] >= nodes[other][2]:
                at = nodes[at][1]
            else:
                other = nodes[other][1]
    while nodes[at][0] not in PART:
        at = nodes[at][1]
    return at


def below(nodes: list[tuple[str, int, int]], node: int, top: int) -> int | None:
    """The element of those right in `top` that a node stands in, `top` if in none, `None` if outside."""
    if node == top:
        return top
    depth = nodes[top][2] + 1
    while nodes[node][2] > depth:
        node = nodes[node][1]
    return node if nodes[node][1] == top and node else None


def kept_lines(page: Lines) -> list[Line]:
    """Lines outside all places, and of the places that hold a main element or most of the text."""
    lines = page.lines
    if not page.places or not lines:
        return lines
    own, whole, kept = [0] * len(page.places), [0] * len(page.places), 0
    for x, yes in zip(lines, clusters(lines)[2]):
        mass = x.unlinked if yes or x.region is not None else 0
        if x.place is None:
            kept += mass
        else:
            own[x.place] += mass
            for place in page.chain(x.place):
                whole[place] += mass
    stay: set[int | None] = {None}
    # A place has as much as those in it, and comes first.
    for place in sorted(range(len(own)), key=lambda k: (k not in page.holds_main, -whole[k], k)):
        if page.places[place] in stay and (place in page.holds_main or whole[place] > kept):
            stay.add(place)
            kept += own[place]
    return [x for x in lines if x.place in stay]


def extract_text(page: str | None) -> str:
    """The article's blocks, joined by newlines."""
    if not page:
        return ""
    parser = parsed(page)
    lines, nodes = kept_lines(parser), parser.nodes
    if not lines:
        return ""
    raw, mean, content = clusters(lines)
    # Clustered characters, each with the weight of its line's ratio, in and outside article and main elements.
    mass = [x.unlinked * min(1.0, r / ENOUGH) if yes else 0.0 for x, r, yes in zip(lines, raw, content)]
    inside = sum(m for x, m in zip(lines, mass) if x.region is not None)
    if inside and REGION_WEIGHT * inside >= sum(mass) - inside:
        regions = {x.region for x, yes in zip(lines, content) if yes and x.region is not None}
        return "\n".join(x.text for x in lines if x.region in regions)
    # Smoothing lends weight to a run's neighbours; its ends must have some of their own.
    ends = [k for k, yes in enumerate(content) if yes and raw[k] >= mean / 4] or [k for k, yes in enumerate(content) if yes]
    first, last = ends[0], ends[-1]
    top = common(nodes, [lines[k].node for k in ends])
    parts = [below(nodes, x.node, top) for x in lines]
    if nodes[top][0] in ("html", "body"):
        # No element holds just the content: parts of the page before and after it go, and lists of links; headings and paragraphs stay.
        dense = {parts[k] for k in ends} - {top}
        parts = [
            part if first <= k <= last or part in dense or part is not None and 2 * x.unlinked > len(x.text) and (part == top or nodes[part][0] not in PART) else None
            for k, (x, part) in enumerate(zip(lines, parts))
        ]
    return "\n".join(x.text for x, part in zip(lines, parts) if part is not None)


def extract(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """pages with the main text of each in column `out`; one of that name is replaced."""

    @F.pandas_udf("string")
    def texts(some: pd.Series) -> pd.Series:
        return pd.Series([extract_text(p) for p in some], dtype=object)

    return pages.withColumn(out, texts(F.col(html).cast("string")))
