"""Main text of web pages: parser events, text-to-tag ratio per line, Gaussian smoothing, clustering by a threshold.

The standard library's streaming parser turns a page into lines (one a block). Containers that are by name or role no
article (menus, forms, scripts, adverts, comments of readers) give no lines. For the others the ratio of text to tags is
smoothed along the page and clustered by a threshold. All lines of the smallest container that holds the upper cluster
are kept, or all articles if they hold most of it, so that a short paragraph isn't lost, however long its neighbours are.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import tune

# Element names of the HTML standard.
RAW = frozenset(("script", "style", "noscript", "template", "iframe", "object", "svg", "canvas", "annotation", "annotation-xml", "head", "title"))
CHROME = frozenset(("nav", "header", "footer", "aside", "button", "select", "textarea", "datalist", "label", "legend", "dialog", "menu"))
#: Of what is hidden, what stands as a block of its own; the rest may stand within a line, which goes on after it.
APART = frozenset(("nav", "header", "footer", "aside", "form", "dialog", "menu", "head"))
BLOCKS = frozenset(
    ("address", "article", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure", "h1", "h2",
     "h3", "h4", "h5", "h6", "hr", "html", "legend", "li", "main", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul")
)
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
REGIONS = frozenset(("article", "main", "section", "div", "body", "td"))
CHROME_ROLES = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form", "menu", "menubar"))
HEAD = frozenset(("title", "style", "script", "noscript", "template", "meta", "link", "base", "basefont", "bgsound", "noframes"))
CHROME_NAME = (
    r"(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|sidebar\w*|footer|header|masthead|cookies?|consent|notice|popup|modal"
    r"|newsletter|subscribe|signup|login|share|social|related|recommend\w*|comments?|disqus|replies|widget|toolbar|pagination|pager|skip)"
)
#: A class or id that is made of such names, but for words that say where or how a part of the page's frame is laid out.
CHROME_NAMES = re.compile(
    rf"(?:(?:site|global|top|bottom|left|right|main(?=[_-]+nav)|primary(?=[_-]+nav))[_-]+)*{CHROME_NAME}(?:[_-]+(?:{CHROME_NAME}|left|right|top|bottom|list|links|items?|bar|box|posts|form|\d+))*", re.I
)
SPACE = re.compile(r"\s+")

SIGMA = 1.0
RADIUS = 3
#: Of the smoothed ratios' standard deviation, the part that a line of content needs at least.
THRESHOLD = 1.0
#: Characters to a tag at which a line counts as dense whatever the other lines have; links in a list have less.
DENSE = 8


class _Lines(HTMLParser):
    """Collects (region, text, tags) for each block outside of chrome, and for each the containers that are chrome by name.

    Those are known only at the end, as the one that holds the page's text is none whatever its name.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[int, str, int]] = []
        self.stack: list[tuple[str, bool, int]] = []
        self.named: set[int] = set()
        self.hidden = 0
        # what stands open: the outermost head's place, and the numbers of articles (a main is one) and of forms
        self.head: int | None = None
        self.articles = self.forms = 0
        self.region = 0
        self.kinds = {0: ""}
        self.parents = {0: -1}
        self.parts: list[str] = []
        self.tags = 0

    def flush(self) -> None:
        if self.parts:
            text = SPACE.sub(" ", "".join(self.parts)).strip()
            if text:
                self.lines.append((self.region, text, self.tags))
                self.tags = 0
            self.parts = []

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID:
            self.tags += 1
            if tag == "hr":
                self.flush()
            elif tag == "br" and not self.hidden:
                self.parts.append(" ")
            return
        if tag not in HEAD and tag != "head":
            self.end_head(tag == "body")
        given = dict(attrs)
        names = f"{given.get('class') or ''} {given.get('id') or ''}".split()
        hides = (
            tag in RAW
            or (tag in CHROME and not (tag == "header" and self.articles) and not (tag == "label" and not self.forms))
            or (given.get("role") or "").lower() in CHROME_ROLES
            or "hidden" in given
            or (given.get("aria-hidden") or "").lower() == "true"
        )
        # a form may hold a whole page, so only its controls are hidden at once
        by_name = tag == "form" or (tag not in ("html", "body", "article", "main") and any(map(CHROME_NAMES.fullmatch, names)))
        named = not hides and not self.hidden and by_name
        if tag in BLOCKS or tag in APART or named:
            self.flush()
        if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):
            self.imply(tag)
        self.tags += 1
        if tag == "head" and self.head is None:
            self.head = len(self.stack)
        self.articles += tag in ("article", "main")
        self.forms += tag == "form"
        self.stack.append((tag, hides, self.region))
        if hides:
            self.hidden += 1
        elif named or (tag in REGIONS and not self.hidden):
            self.parents[len(self.kinds)] = self.region
            self.region = len(self.kinds)
            self.kinds[self.region] = tag
            if named:
                self.named.add(self.region)

    def end_head(self, always: bool) -> None:
        """The end of an open head, whose end tag may be left out; always: even if a part of the head is still open."""
        n = self.head
        if n is not None and (always or n == len(self.stack) - 1):
            self.cut(n)

    def imply(self, tag: str) -> None:
        """A new paragraph, item or cell ends the one that is open in the same container."""
        for n in range(len(self.stack) - 1, -1, -1):
            name = self.stack[n][0]
            if name == tag:
                self.cut(n)
                return
            if name in REGIONS or name in ("ul", "ol", "dl", "table", "blockquote"):
                return

    def cut(self, n: int) -> None:
        self.region = self.stack[n][2]
        self.hidden -= sum(x[1] for x in self.stack[n:])
        self.articles -= sum(x[0] in ("article", "main") for x in self.stack[n:])
        self.forms -= sum(x[0] == "form" for x in self.stack[n:])
        if self.head is not None and self.head >= n:
            self.head = None
        del self.stack[n:]

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in VOID:
            return
        for n in range(len(self.stack) - 1, -1, -1):
            if self.stack[n][0] == tag:
                if tag in BLOCKS or tag in REGIONS or self.region != self.stack[n][2] or any(x[0] in BLOCKS or x[0] in APART for x in self.stack[n:]):
                    self.flush()
                self.cut(n)
                return

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_data(self, data: str) -> None:
        if self.hidden and self.stack[-1][0] == "head" and data.strip():
            self.end_head(True)
        if not self.hidden:
            self.parts.append(data)


def unhidden(parser: _Lines) -> list[tuple[int, str, int]]:
    """The lines without those of containers that are chrome by name.

    A form that holds most of the page's text is none. If no article outside of them has text, those that hold an article
    with text are none; if there is no such article either, those that hold most of the page's text.
    """
    total = sum(len(text) for _, text, _ in parser.lines)
    # regions are numbered from outside to inside
    within = [0] * len(parser.kinds)
    for region, text, _ in parser.lines:
        within[region] += len(text)
    for region in range(len(within) - 1, 0, -1):
        within[parser.parents[region]] += within[region]
    parser.named -= {r for r in parser.named if parser.kinds[r] == "form" and 2 * within[r] > total}
    # regions are numbered from outside to inside, so each takes from its parent: the named ones around it (itself
    # included), and the named ones around the outermost article it is in
    chrome: dict[int, frozenset[int]] = {-1: frozenset()}
    of_article: dict[int, frozenset[int] | None] = {-1: None}
    for region, kind in parser.kinds.items():
        up = parser.parents[region]
        of_article[region] = chrome[up] if of_article[up] is None and kind in ("article", "main") else of_article[up]
        chrome[region] = chrome[up] | {region} if region in parser.named else chrome[up]
    shown = set()
    if not any(of_article[r] is not None and not chrome[r] for r, _, _ in parser.lines):
        articles = set()
        for region, _, _ in parser.lines:
            articles |= of_article[region] or frozenset()
        shown = articles or {at for at in parser.named if 2 * within[at] > total}
    return [x for x in parser.lines if chrome[x[0]] <= shown]


def smoothed(values: list[float]) -> list[float]:
    """Gaussian smoothing; at the ends the kernel is cut and scaled."""
    kernel = [math.exp(-(d * d) / (2 * SIGMA * SIGMA)) for d in range(-RADIUS, RADIUS + 1)]
    out = []
    for n in range(len(values)):
        total = weight = 0.0
        for d in range(-RADIUS, RADIUS + 1):
            if 0 <= n + d < len(values):
                total += kernel[d + RADIUS] * values[n + d]
                weight += kernel[d + RADIUS]
        out.append(total / weight)
    return out


def content_blocks(html: str) -> list[str]:
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    lines = unhidden(parser)
    if not lines:
        return []
    # in logarithms, so that one long block doesn't raise the threshold above all others
    own = [math.log1p(len(text) / max(1, tags)) for _, text, tags in lines]
    ratios = smoothed(own)
    mean = sum(ratios) / len(ratios)
    spread = math.sqrt(sum((r - mean) ** 2 for r in ratios) / len(ratios))
    least = min(THRESHOLD * spread, mean)
    # a line is not dense by its neighbours alone
    alone = min(sum(own) / len(own) / 2, math.log1p(DENSE))
    dense = [(region, len(text)) for (region, text, _), r, o in zip(lines, ratios, own, strict=True) if r >= least and o >= alone] or [(region, len(text)) for region, text, _ in lines]
    in_article, last = {-1: False}, list(range(len(parser.kinds)))
    for region, kind in parser.kinds.items():
        in_article[region] = in_article[parser.parents[region]] or kind in ("article", "main")
    inside = sum(n for region, n in dense if in_article[region])
    if 2 * inside >= sum(n for _, n in dense):
        return [text for region, text, _ in lines if in_article[region]]
    # regions are numbered as they open, so all that a region holds lies between it and the last one in it
    for region in range(len(last) - 1, 0, -1):
        up = parser.parents[region]
        last[up] = max(last[up], last[region])
    common, furthest = min(region for region, _ in dense), max(region for region, _ in dense)
    while last[common] < furthest:
        common = parser.parents[common]
    return [text for region, text, _ in lines if common <= region <= last[common]]


SCHEMA = "page_id long, url string, text string, n_chars long, n_blocks long"
ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64()), ("n_blocks", pa.int64())])


def main_text(pages: DataFrame) -> DataFrame:
    """The main text of each row of pages (page_id, url, html): page_id, url, text, n_chars, n_blocks.

    Null or empty html, and pages without text outside of chrome, give an empty text. Rows that repeat give rows that
    repeat; other columns are ignored. Nothing is cut: a page of any length is parsed as a whole, one at a time.
    """
    tune(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [content_blocks(h.as_py()) if h.is_valid else [] for h in batch.column(2)]
            texts = ["\n".join(x) for x in found]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), pa.array(map(len, found), pa.int64())], schema=ARROW)

    return pages.select(pages.page_id.cast("long").alias("page_id"), pages.url.cast("string").alias("url"), pages.html.cast("string").alias("html")).mapInArrow(run, SCHEMA)
