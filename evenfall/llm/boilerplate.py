"""Page boilerplate mixed with main content.

A page is read as a stream of parser events. They give the lines of its visible text, and for each line its characters, the share of
them in links, the tags before it and the element that holds it. The text-to-tag ratio of the lines is smoothed with a Gaussian, and the
page's mean is the threshold between content and boilerplate. Lines cluster by the elements that hold them: an element's excess is
the sum of its lines' ratios over the threshold, so boilerplate in it counts against it, and the element with the greatest excess is the body. The
page's heading, or a line that the page's title repeats, is evidence for the elements that hold it. Lines outside the body are boilerplate, and
so are lines in it that are made of links to menus or sharing, or that read like a notice. Descriptions have no tags, so their lines are
judged by wording alone.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenfall.functions.html import BLOCKS, CLOSES, DROPPED, VOID, tamed
from evenfall.llm import furniture, residue

#: What a paragraph that is still open doesn't reach beyond.
_SCOPE = frozenset(("table", "td", "th", "li", "dd", "div", "section", "article", "main", "body", "html", "blockquote", "aside", "footer", "header", "nav", "form"))
#: Spread of the Gaussian over the lines, and how far it reaches.
SIGMA, REACH = 1.5, 3
_KERNEL = [math.exp(-(k * k) / (2 * SIGMA * SIGMA)) for k in range(-REACH, REACH + 1)]
#: What the page's heading counts for, in standard deviations of the smoothed ratios.
HEADING = 6.0


class Line:
    __slots__ = ("element", "heading", "links", "tags", "text")

    def __init__(self, text: str, links: int, tags: int, element: int, heading: bool) -> None:
        self.text, self.links, self.tags, self.element, self.heading = text, links, tags, element, heading


class Reader(HTMLParser):
    """Lines of the visible text with what stands around them."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.stack: list[tuple[str, int]] = []
        #: The element that holds an element; 0 holds all, and elements are numbered as they open.
        self.parent = [0]
        self.headings = 0
        self.hidden = 0
        self.hidden_tag = ""
        self.buffer: list[str] = []
        self.link_chars = 0
        self.tags = 0
        self.in_link = 0
        self.title: list[str] = []
        self.in_title = False

    def flush(self) -> None:
        text = "".join(self.buffer)
        self.buffer = []
        parts = [" ".join(p.split()) for p in text.splitlines()]
        parts = [p for p in parts if p]
        if not parts:
            return
        element = self.stack[-1][1] if self.stack else 0
        total = sum(map(len, parts)) or 1
        for p in parts:
            self.lines.append(Line(p, round(self.link_chars * len(p) / total), self.tags, element, self.headings > 0))
            self.tags = 0
        self.link_chars = 0

    def pop(self, tag: str, within: frozenset | tuple = ()) -> None:
        """Close the nearest open element of this name, with all that is open in it; not beyond the named elements."""
        for k in range(len(self.stack) - 1, -1, -1):
            name = self.stack[k][0]
            if name == tag:
                for t, _ in self.stack[k:]:
                    self.in_link -= t == "a"
                    self.headings -= t == "h1"
                del self.stack[k:]
                return
            if name in within:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.hidden:
            if tag == self.hidden_tag and tag not in VOID:
                self.hidden += 1
            elif self.hidden_tag == "head":
                if tag == "title":
                    self.in_title = True
                elif tag == "body" or tag in BLOCKS:
                    self.hidden = 0
            if self.hidden:
                return
        if tag in DROPPED:
            self.hidden, self.hidden_tag = 1, tag
            return
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
            if tag in CLOSES:
                names, within = CLOSES[tag]
                for n in names:
                    self.pop(n, within)
            elif tag != "br" and any(t == "p" for t, _ in self.stack):
                self.pop("p", _SCOPE)
        if tag in VOID:
            return
        self.parent.append(self.stack[-1][1] if self.stack else 0)
        self.stack.append((tag, len(self.parent) - 1))
        self.in_link += tag == "a"
        self.headings += tag == "h1"

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if not self.hidden and tag in BLOCKS:
            self.flush()
        self.tags += not self.hidden

    def handle_endtag(self, tag: str) -> None:
        if self.hidden:
            if tag == "title":
                self.in_title = False
            if tag == self.hidden_tag:
                self.hidden -= 1
            return
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
        if tag not in ("html", "body"):
            self.pop(tag, ("table",) if tag not in ("table", "tbody") and tag in ("p", "li", "a", "b", "span", "em", "i", "strong") else ())

    def handle_data(self, data: str) -> None:
        if self.in_title:
            self.title.append(data)
        if not self.hidden:
            self.buffer.append(data)
            if self.in_link > 0:
                self.link_chars += len(data.strip())


def read(html: str) -> Reader:
    r = Reader()
    try:
        r.feed(tamed(html))
        r.close()
    except (AssertionError, ValueError):  # markup that the parser gives up on: what it has read so far counts
        pass
    r.flush()
    return r


def visible_lines(html: str) -> list[str]:
    """Lines of the visible text, white space collapsed, empty ones dropped."""
    return [x.text for x in read(html).lines] if html else []


def smoothed(lines: list[Line]) -> list[float]:
    """Gaussian-smoothed characters outside links per tag."""
    raw = [(len(x.text) - x.links) / (1 + x.tags) for x in lines]
    out = []
    for i in range(len(raw)):
        total = weight = 0.0
        for k in range(-REACH, REACH + 1):
            if 0 <= i + k < len(raw):
                total += _KERNEL[k + REACH] * raw[i + k]
                weight += _KERNEL[k + REACH]
        out.append(total / weight)
    return out


def body_element(reader: Reader) -> int:
    """The element with the greatest excess of smoothed ratios over the page's mean; of equal ones the innermost."""
    lines = reader.lines
    if not lines:
        return 0
    ratios = smoothed(lines)
    mean = sum(ratios) / len(ratios)
    spread = math.sqrt(sum((x - mean) ** 2 for x in ratios) / len(ratios))
    title = " ".join("".join(reader.title).split()).lower()
    excess = [0.0] * len(reader.parent)
    held = [0] * len(reader.parent)
    named = False
    for line, x in zip(lines, ratios):
        heading = not named and (line.heading or (len(line.text) > 3 and line.text.lower() in title))
        named = named or heading
        excess[line.element] += x - mean + (HEADING * spread if heading else 0.0)
        held[line.element] += 1
    for i in range(len(excess) - 1, 0, -1):  # an element opens after the one that holds it
        excess[reader.parent[i]] += excess[i]
        held[reader.parent[i]] += held[i]
    return max((i for i in range(len(excess)) if held[i]), key=lambda i: (round(excess[i], 6), i))


def boilerplate_lines(html: str | None) -> list[int]:
    """Numbers, from 1, of the lines of a page's visible text that are not main body."""
    if not html:
        return []
    r = read(html)
    body = body_element(r)
    inside = [i == body for i in range(len(r.parent))]
    for i in range(1, len(inside)):
        inside[i] = inside[i] or inside[r.parent[i]]
    return [n for n, x in enumerate(r.lines, 1) if not inside[x.element] or (not x.heading and furniture.reads_like(x.text))]


def mixed_lines(text: str | None) -> list[int]:
    """Numbers, from 1, of the furniture lines of a description; none if it has no main body besides."""
    if not text:
        return []
    lines = text.split("\n")
    found = [n for n, x in enumerate(lines, 1) if x.strip() and furniture.reads_like(x)]
    return found if len(found) < sum(1 for x in lines if x.strip()) else []


def _pages(html: pd.Series) -> pd.Series:
    return pd.Series([boilerplate_lines(x) for x in html], dtype=object)


def _texts(text: pd.Series) -> pd.Series:
    return pd.Series([mixed_lines(x) for x in text], dtype=object)


def boilerplate(cases: DataFrame, events: DataFrame) -> DataFrame:
    """(record_kind, record_id, line_no): lines that are not main body, of pages (case) and descriptions (event).

    Null and empty pages and descriptions have no rows, nor have descriptions that are residue. Lines of descriptions are split at
    line feeds; a description of furniture only is not mixed and has no rows. Repeated rows each count.
    """
    pages = F.pandas_udf(_pages, "array<int>")
    texts = F.pandas_udf(_texts, "array<int>")
    c = cases.where("html IS NOT NULL").select(F.lit("case").alias("record_kind"), F.col("case_id").cast("long").alias("record_id"), F.explode(pages("html")).alias("line_no"))
    fields = residue.fields_of(events)
    model = residue.learn(fields)
    d = events.select("event_id", F.col("description").alias("text"), F.lit("description").alias("field_name")).where(F.instr("text", "\n") > 0)
    d = d.select("event_id", "text", "field_name", texts("text").alias("lines")).where(F.size("lines") > 0)
    d = residue.scored(d, model).where("score <= 0")
    e = d.select(F.lit("event").alias("record_kind"), F.col("event_id").cast("long").alias("record_id"), F.explode("lines").alias("line_no"))
    return c.unionByName(e)
