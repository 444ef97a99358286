"""Reading pages: one pass of the standard library's parser gives everything that the extraction operators look at.

PARSED is the struct that parse() returns for a page; the pandas function parsed() makes a column of it. Broken markup never fails a
row: what was read before the parser gave up counts.
"""

from __future__ import annotations

import json
import re
from html import unescape
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements whose text is not visible, and those that break lines.
DROPPED = frozenset(("script", "style", "noscript", "template", "svg", "head"))
BLOCKS = frozenset("address article aside blockquote br dd div dl dt figcaption footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# What an opening tag closes if it is still open, up to the element that holds both.
CLOSES = {"li": (("li",), ("ul", "ol", "menu")), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "tr": (("tr", "td", "th"), ("table",)), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "option": (("option",), ("select",)), "p": (("p",), ("div", "td", "li", "section", "article", "body"))}

PARSED = (
    "title string, lang string, h1 string, metas array<struct<key:string,content:string>>, link_rels array<struct<rel:string,type:string,href:string>>, jsonld array<string>, scripts array<struct<attrs:string,text:string>>, "
    "anchors array<struct<pos:int,href:string,url:string,text:string,rel:string,cls:string,in_nav:boolean,in_chrome:boolean,signature:string>>, iframes array<string>, microdata array<string>, visible_text string"
)
_FIELDS = ("title", "lang", "h1", "metas", "link_rels", "jsonld", "scripts", "anchors", "iframes", "microdata", "visible_text")


class Element:
    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: "Element | None") -> None:
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Element | str] = []

    def text(self) -> str:
        out: list[str] = []
        stack: list[Element | str] = [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                out.append(n)
            else:
                stack.extend(reversed(n.children))
        return "".join(out)

    def words(self) -> str:
        return " ".join(self.text().split())

    def walk(self):
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(c for c in reversed(n.children) if isinstance(c, Element))

    def ancestors(self):
        n = self.parent
        while n is not None:
            yield n
            n = n.parent

    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Element("#root", {}, None)
        self.here = self.root

    def close_to(self, tag: str, within: tuple[str, ...] = ()) -> None:
        n = self.here
        while n.parent is not None:
            if n.tag == tag:
                self.here = n.parent
                return
            if n.tag in within:
                return
            n = n.parent

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in CLOSES:
            names, within = CLOSES[tag]
            for name in names:
                self.close_to(name, within)
        e = Element(tag, {k: v or "" for k, v in attrs}, self.here)
        self.here.children.append(e)
        if tag not in VOID:
            self.here = e

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.here.children.append(Element(tag, {k: v or "" for k, v in attrs}, self.here))

    def handle_endtag(self, tag: str) -> None:
        if tag not in VOID:
            self.close_to(tag)

    def handle_data(self, data: str) -> None:
        self.here.children.append(data)


#: A sign that opens no tag: dozens more follow without any that closes one. The parser would take a time quadratic in their number.
_STRAY = re.compile(r"<(?=(?:[^<>]*<){30})")


def tamed(html: str) -> str:
    return _STRAY.sub("&lt;", html)


def tree(html: str | None) -> Element:
    b = _Builder()
    try:
        b.feed(tamed(html or ""))
        b.close()
    except (AssertionError, ValueError):
        pass
    return b.root


def visible_text(root: Element) -> str:
    """One line per block element, white space collapsed, empty lines dropped; scripts, styles and the head left out."""
    out: list[str] = []

    def read(e: Element) -> None:
        for c in e.children:
            if isinstance(c, str):
                out.append(c)
            elif c.tag not in DROPPED:
                if c.tag in BLOCKS:
                    out.append("\n")
                    read(c)
                    out.append("\n")
                else:
                    read(c)

    try:
        read(root)
    except RecursionError:  # absurdly deep markup: take the text as it comes
        return " ".join(root.text().split())
    lines = (" ".join(x.split()) for x in "".join(out).splitlines())
    return "\n".join(x for x in lines if x)


def _signature(a: Element) -> str:
    parts, n = [], a
    for _ in range(4):
        if n is None or n.tag == "#root":
            break
        c = n.classes()
        parts.append(f"{n.tag}.{c[0]}" if c else n.tag)
        n = n.parent
    return ">".join(reversed(parts))


def _anchors(root: Element, url: str) -> list[tuple]:
    out = []
    for pos, a in enumerate(x for x in root.walk() if x.tag == "a" and "href" in x.attrs):
        up = list(a.ancestors())
        href = a.attrs["href"].strip()
        try:
            full = urljoin(url or "", href)
        except ValueError:
            full = href
        text = a.words() or a.attrs.get("title", "") or a.attrs.get("aria-label", "")
        named = any(w in f"{e.attrs.get('class', '')} {e.attrs.get('id', '')}" for e in up for w in ("nav", "menu"))
        out.append((pos, href, full, text, a.attrs.get("rel", ""), a.attrs.get("class", ""), named or any(e.tag in ("nav", "header") for e in up), any(e.tag in ("nav", "header", "footer") for e in up), _signature(a)))
    return out


def _item(e: Element, depth: int = 0) -> dict:
    """A microdata item with its properties, nested items inside."""
    kind = (e.attrs.get("itemtype") or "").rstrip("/").rpartition("/")[2]
    out: dict = {"@type": kind}
    stack = [c for c in reversed(e.children) if isinstance(c, Element)]
    while stack:
        n = stack.pop()
        prop = n.attrs.get("itemprop")
        if prop:
            if "itemscope" in n.attrs and depth < 6:
                value: object = _item(n, depth + 1)
            else:
                value = n.attrs.get("content") or n.attrs.get("datetime") or n.attrs.get("href") or n.attrs.get("src") or n.words()
            for name in prop.split():
                out.setdefault(name, value)
        if "itemscope" not in n.attrs:
            stack.extend(c for c in reversed(n.children) if isinstance(c, Element))
    return out


def parse(html: str | None, url: str | None = None) -> tuple:
    root = tree(html)
    title = h1 = lang = None
    metas, rels, jsonld, scripts, iframes, microdata = [], [], [], [], [], []
    for e in root.walk():
        t = e.tag
        if t == "title" and title is None:
            title = e.words()
        elif t == "h1" and h1 is None:
            h1 = e.words()
        elif t == "html" and lang is None:
            lang = e.attrs.get("lang")
        elif t == "meta":
            k = e.attrs.get("property") or e.attrs.get("name")
            if k:
                metas.append((k, e.attrs.get("content")))
        elif t == "link" and e.attrs.get("href"):
            rels.append((e.attrs.get("rel"), e.attrs.get("type"), e.attrs["href"]))
        elif t == "script":
            attrs = " ".join(f'{k}="{v}"' for k, v in e.attrs.items())
            (jsonld if "ld+json" in attrs.lower() else scripts).append(e.text() if "ld+json" in attrs.lower() else (attrs, e.text()))
        elif t == "iframe" and e.attrs.get("src"):
            iframes.append(e.attrs["src"])
        elif "itemscope" in e.attrs and "itemprop" not in e.attrs and "Event" in (e.attrs.get("itemtype") or ""):
            microdata.append(json.dumps(_item(e), ensure_ascii=False))
    return title, lang, h1, metas, rels, jsonld, scripts, _anchors(root, url or ""), iframes, microdata, visible_text(root)


def _parse_batch(html: pd.Series, url: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([parse(h, u) for h, u in zip(html, url)], columns=_FIELDS)


def parsed(html: Column, url: Column) -> Column:
    """The PARSED struct of a page. Null pages give null members and empty arrays."""
    return F.pandas_udf(_parse_batch, PARSED)(html, url)


_TAG = re.compile(r"<[^<>]+>")


def plain(text: str | None) -> str | None:
    """An HTML fragment as text."""
    if not text:
        return None
    return " ".join(unescape(_TAG.sub(" ", text)).split()) or None


def _plain_batch(text: pd.Series) -> pd.Series:
    return pd.Series([plain(t) for t in text], dtype=object)


def plain_text(text: Column) -> Column:
    return F.pandas_udf(_plain_batch, "string")(text)
