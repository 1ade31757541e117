"""Main text of web pages from a stream of parser events.

The standard parser is fed piece by piece; its events become lines, one per
block of text, each with its characters and the tags met in it.  The ratio of
text to tags per line is smoothed with a Gaussian, and a threshold clusters the
lines into content and the rest.  What a page says about its parts only weighs in:
a line of an article counts more, one of a menu, a footer, an advert or reader
comments much less, one of a vague name (``legal``, ``related``) a little less.

The regions of content are the articles that hold content lines or, where none
does, the nearest container that holds nearly all content.  A region is kept whole,
so that a short paragraph between long ones stays; only its lines that are marked
as something else must reach the threshold themselves.  Pages without a content
line have no text.
"""

from __future__ import annotations

import collections
import re
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estatelens.llm import common

PIECE = 1 << 16
SIGMA = 1.0
#: A line is content if its smoothed ratio reaches this share of the mean over unmarked lines.
THRESHOLD = 0.5
#: What a ratio counts in an article, under a mark, and under a vague mark in and outside an article.
ARTICLE, MARK, VAGUE_INSIDE, VAGUE = 3.0, 0.05, 0.6, 0.2
#: The share of the content's characters that makes a container the region.
SHARE = 0.9

# Elements by what they are.
SILENT = {"script", "style", "noscript", "template", "head", "title", "svg", "iframe", "object", "canvas", "select", "button",
          "textarea", "datalist", "math", "audio", "video"}
ASIDE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset", "search"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr", "param"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt",
          "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li",
          "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CONTAINERS = {"article", "main", "section", "div", "td", "body", "ul", "ol", "dl", "table", "blockquote"}
ENDS_PARAGRAPH = BLOCKS - {"body", "html"}
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert\w*|sponsor\w*|promo\w*|breadcrumbs?|menu|nav|navbar|navigation|sidebar|footer|"
    r"masthead|cookies?|consent|gdpr|popup|modal|newsletter|subscribe|signup|share|sharing|social|"
    r"comments?|comment-list|disqus|replies|pagination|pager)(?:$|[\s_-])", re.I)
UNSURE = re.compile(
    r"(?:^|[\s_-])(?:banner|header|notice|related|recommended|side|widget|toolbar|legal|copyright|skip)(?:$|[\s_-])", re.I)
REMARKS = re.compile(r"(?:^|[\s_-])(?:comments?|comment-list|disqus|replies)(?:$|[\s_-])", re.I)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "menubar", "form"}


class Open(NamedTuple):
    """An open element: what its text is."""
    tag: str = ""
    silent: bool = False
    mark: str = ""  # "", "vague", "name" (of a class) or "tag"
    container: int = 0
    article: int = 0  # the innermost article's container


class Line(NamedTuple):
    text: str
    ratio: float
    linked: int
    mark: str
    container: int
    article: int


class Lines(HTMLParser):
    """Lines of a page, and its containers by their parents (a parent's number is smaller)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[Open] = []
        self.lines: list[Line] = []
        self.parents = [0]
        self.tops = {0}  # the page itself and its body
        self.text: list[str] = []
        self.tags = self.links = self.linked = 0

    def _top(self) -> Open:
        return self.open[-1] if self.open else Open()

    def flush(self):
        line = " ".join("".join(self.text).split())
        if line:
            top = self._top()
            self.lines.append(Line(line, len(line) / max(1, self.tags), self.linked, top.mark, top.container, top.article))
            self.tags = 0
        self.text = []
        self.linked = 0

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag == "br":
            self.text.append(" ")
            return
        if tag in BLOCKS:
            self.flush()
        if tag in VOID:
            return
        self.links += tag == "a"
        if tag in ENDS_PARAGRAPH:
            self._close("p", {"td", "th", "div", "section", "article", "li", "body", "button"})
        if tag == "li":
            self._close("li", {"ul", "ol", "menu"})
        elif tag in ("dt", "dd"):
            self._close("dt", {"dl"})
            self._close("dd", {"dl"})
        elif tag in ("tr", "td", "th"):
            for cell in ("td", "th", "tr") if tag == "tr" else ("td", "th"):
                self._close(cell, {"table"})
        elif tag == "body":
            self._close("head", set())
        top = self._top()
        told = dict(attrs)
        label = f"{told.get('class') or ''} {told.get('id') or ''}"
        silent = top.silent or tag in SILENT or "hidden" in told or told.get("aria-hidden") == "true" \
            or "display:none" in (told.get("style") or "").replace(" ", "").lower()
        container, article, mark = top.container, top.article, top.mark
        if tag in CONTAINERS:
            self.parents.append(container)
            container = len(self.parents) - 1
            if tag == "body":
                self.tops.add(container)
        remarks = bool(REMARKS.search(label))
        if remarks and tag not in ("html", "body"):
            mark = "tag"
        elif tag in ("article", "main"):
            if not any(x.tag == "remarks" for x in self.open):
                # an article ends what was left open around it: menus and notices do not hold articles
                mark, article = "", container
        elif tag in HEADINGS:
            if article and self._in_header_of_article():
                mark = ""
        elif tag not in ("html", "body"):
            if tag in ASIDE or (told.get("role") or "").lower() in ROLES:
                mark = "tag"
            elif MARKED.search(label):
                mark = mark if mark == "tag" else "name"
            elif UNSURE.search(label):
                mark = mark or "vague"
        if remarks:
            self.open.append(Open("remarks", silent, mark, container, article))
        self.open.append(Open(tag, silent, mark, container, article))

    def _in_header_of_article(self) -> bool:
        """Within an article's own header, and nothing else that does not count."""
        inside = [x for x in self.open if x.mark]
        return bool(inside) and all(x.tag in ("header", "div", "hgroup") for x in inside) and inside[0].tag == "header"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _close(self, tag: str, up_to: set):
        """Close an open ``tag`` that no element of ``up_to`` hides."""
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i].tag == tag:
                self.flush()
                del self.open[i:]
                return
            if self.open[i].tag in up_to:
                return

    def handle_endtag(self, tag):
        self.tags += 1
        if tag == "a":
            self.links = max(0, self.links - 1)
        if tag in BLOCKS:
            self.flush()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i].tag == tag:
                if any(x.tag in BLOCKS for x in self.open[i + 1:]):
                    self.flush()
                del self.open[i:]
                if self.open and self.open[-1].tag == "remarks":
                    self.open.pop()
                return

    def handle_data(self, data):
        if not self._top().silent:
            self.text.append(data)
            if self.links:
                self.linked += len(data)


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = max(1, int(np.ceil(3 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(np.pad(ratios, reach, mode="edge"), kernel / kernel.sum(), mode="valid")


def weight(line: Line, named: bool) -> float:
    """What a line's ratio counts; class names count for nothing if not ``named``."""
    mark = line.mark if named or line.mark == "tag" else ""
    if mark in ("tag", "name"):
        return MARK
    own = ARTICLE if line.article else 1.0
    return own * (VAGUE_INSIDE if line.article else VAGUE) if mark else own


def region(page: Lines, content: np.ndarray) -> np.ndarray:
    """Which lines the region of the content lines holds, marked ones too."""
    lines = page.lines
    articles = {x.article for x, c in zip(lines, content) if c and x.article}
    if articles:
        return np.array([x.article in articles for x in lines])
    mass = [0] * len(page.parents)
    for x, c in zip(lines, content):
        mass[x.container] += c * len(x.text)
    for i in range(len(mass) - 1, 0, -1):
        mass[page.parents[i]] += mass[i]
    main = 0
    for i in range(1, len(mass)):  # parents come first, and only one child can hold so much
        if page.parents[i] == main and mass[i] >= SHARE * mass[0]:
            main = i
    # the child of the region that a container is in, -1 outside
    branch = [-1] * len(mass)
    branch[main] = main
    for i in range(main + 1, len(mass)):
        parent = page.parents[i]
        branch[i] = i if parent == main else branch[parent]
    linked, size = collections.Counter(), collections.Counter()
    for x in lines:
        linked[branch[x.container]] += x.linked
        size[branch[x.container]] += len(x.text)
    # smoothing makes content of a menu's lines beside the article's: most of a child's text decides
    full = {b for b in size if b == main or 2 * mass[b] > size[b]} or {b for b in size if b >= 0 and mass[b]}
    inner = [i for i, (x, c) in enumerate(zip(lines, content)) if c and branch[x.container] in full]

    def holds(i: int, x: Line) -> bool:
        b = branch[x.container]
        return b >= 0 and (b in full or (bool(inner) and inner[0] < i < inner[-1])
                           or (main not in page.tops and 2 * linked[b] <= size[b]))

    return np.array([holds(i, x) for i, x in enumerate(lines)])


def main_text(html: str | None, sigma: float = SIGMA, threshold: float = THRESHOLD) -> str:
    """Blocks of the main text joined by an empty line; "" if there is none."""
    page = Lines()
    for at in range(0, len(html or ""), PIECE):
        page.feed(html[at:at + PIECE])
    page.close()
    page.flush()
    if not page.lines:
        return ""
    # a page that is marked as a whole is not marked at all
    named = any(not x.mark for x in page.lines)
    weights = np.array([weight(x, named) for x in page.lines])
    ratios = np.array([x.ratio for x in page.lines]) * weights
    plain = np.array([x.mark == "" or not (named or x.mark == "tag") for x in page.lines])
    if not plain.any():
        return ""
    marked = np.where(plain, 1.0, np.where(weights <= MARK, MARK, np.minimum(weights, 1.0)))
    content = smoothed(ratios, sigma) * marked >= threshold * ratios[plain].mean()
    if not content.any():
        return ""
    held = region(page, content) & (plain | content)
    return "\n\n".join(x.text for x, h in zip(page.lines, held) if h)


def extract(pages: DataFrame, html: str = "html", kept: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``kept`` columns, text and n_chars (code points) of every row; null html is empty."""
    common.ship_package(pages.sparkSession)
    schema = pages.select(*kept, F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema

    def run(batches):
        for part in common.slices(batches, html):
            texts = [main_text(x) for x in common.column_of(part, html).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(common.column_of(part, c) for c in kept), pa.array(texts, pa.string()),
                                              pa.array([len(x) for x in texts], pa.int64())], names=[*kept, "text", "n_chars"])

    return pages.select(*kept, html).mapInArrow(run, schema)


def op6(spark, sf_dir):
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
