"""HTML tree work in Arrow batches: a tolerant reader that closes what authors left open."""

from __future__ import annotations

import re
from html import escape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
PICTURES = frozenset("img svg figure figcaption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
WRAPPERS = frozenset(("pg-header", "pg-footer"))
#: An open paragraph ends where one of these begins.
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
CLOSES_SAME = frozenset("li dt dd tr td th option".split())


class Node:
    """An element, or a text where tag is None."""

    __slots__ = ("tag", "attrs", "children", "text")

    def __init__(self, tag: str | None, attrs: dict[str, str] | None = None, text: str = ""):
        self.tag, self.attrs, self.children, self.text = tag, attrs or {}, [], text

    def walk(self):
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(reversed(node.children))

    def content(self) -> str:
        return "".join(n.text for n in self.walk() if n.tag is None)

    def html(self) -> str:
        if self.tag is None:
            return escape(self.text, quote=False)
        inner = "".join(c.html() for c in self.children)
        attrs = "".join(f' {k}="{escape(v)}"' for k, v in self.attrs.items())
        return f"<{self.tag}{attrs}>" + ("" if self.tag in VOID else f"{inner}</{self.tag}>")


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root")
        self.open = [self.root]

    def _close(self, tag: str, within: frozenset[str] = frozenset()) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            if self.open[i].tag in within:
                return

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            self._close("p", frozenset(("section", "div", "td", "li", "blockquote", "article")) - {tag})
        if tag in CLOSES_SAME:
            self._close(tag, frozenset(("ul", "ol", "table", "dl")))
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._close(tag)

    def handle_endtag(self, tag):
        self._close(tag)

    def handle_data(self, data):
        if self.open[-1].tag not in ("script", "style"):
            self.open[-1].children.append(Node(None, text=data))


def parse(html: str) -> Node:
    reader = _Reader()
    reader.feed(html)
    reader.close()
    return reader.root


def body_of(root: Node) -> Node:
    return next((n for n in root.walk() if n.tag == "body"), root)


def _same_page(href: str) -> str:
    if re.match(r"[a-z]+:", href, re.I) or href.startswith("#"):
        return href
    file, *rest = href.split("#")
    return "#" + (rest[0] if rest else re.sub(r"\.(?:xhtml|html|htm)$", "", file.rsplit("/", 1)[-1], flags=re.I))


def _tidy(node: Node) -> None:
    """Boilerplate wrappers and pictures out, anchors without target unwrapped, links made local, attributes but id and href dropped."""
    kept = []
    for child in node.children:
        if child.tag in PICTURES or child.attrs.get("id") in WRAPPERS or child.tag in ("script", "style"):
            continue
        _tidy(child)
        if child.tag == "a" and "href" not in child.attrs:
            kept.extend(child.children)
            continue
        child.attrs = {k: _same_page(v) if k == "href" and v else v for k, v in child.attrs.items() if k in ("id", "href")}
        kept.append(child)
    node.children = kept


def html_blocks(html: str) -> list[tuple[str, str]]:
    """(html, text) of the body's blocks in reading order; one level of div is unwrapped."""
    body = body_of(parse(html))
    _tidy(body)
    out = []
    for node in body.children:
        if node.tag is None:
            continue
        for block in node.children if node.tag == "div" else [node]:
            if block.tag is not None and (text := block.html().strip()):
                out.append((text, block.content()))
    return out


def anchored(html: str) -> str:
    """HTML with numbered paragraphs in a section; what has paragraph ids already is returned as it is."""
    root = parse(html)
    ps = [n for n in root.walk() if n.tag == "p"]
    if any("id" in p.attrs for p in ps):
        return html
    for i, p in enumerate(ps):
        p.attrs = {"id": f"text-p{i + 1}", **p.attrs}
    inner = "".join(c.html() for c in body_of(root).children)
    return inner if any(n.tag == "section" and "id" in n.attrs for n in root.walk()) else f'<section id="text">\n{inner}\n</section>'


def contents(html: str) -> list[tuple[str, str]]:
    """(id, heading) of the body's top-level sections that have both."""
    found = []
    for node in body_of(parse(html)).children:
        if node.tag == "section" and node.attrs.get("id"):
            heading = next((n for n in node.walk() if n.tag in HEADINGS), None)
            if heading is not None and (title := heading.content().strip()):
                found.append((node.attrs["id"], title))
    return found


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("id", T.StringType()), T.StructField("title", T.StringType())])))
def contents_udf(html: pd.Series) -> pd.Series:
    return html.map(lambda h: [{"id": a, "title": b} for a, b in contents(h)] if h else [])


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("html", T.StringType()), T.StructField("text", T.StringType())])))
def blocks_udf(html: pd.Series) -> pd.Series:
    return html.map(lambda h: [{"html": a, "text": b} for a, b in html_blocks(h)] if h else [])


@F.pandas_udf(T.StringType())
def anchored_udf(html: pd.Series) -> pd.Series:
    return html.map(lambda h: None if h is None else anchored(h))


@F.pandas_udf(T.ArrayType(T.StringType()))
def paragraph_texts(html: pd.Series) -> pd.Series:
    """Text of every paragraph, implied ends included, white space collapsed."""
    return html.map(lambda h: [" ".join(n.content().split()) for n in parse(h).walk() if n.tag == "p"] if h else [])
