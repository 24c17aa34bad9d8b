"""Web pages and sectioned documents to rows: the one place where Python walks a tree."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame

# Tags and classes by their part in a document.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = set("address article aside blockquote body dd div dl dt figcaption figure footer h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tbody td tfoot th thead tr ul".split())
SKIP_TAGS = {"script", "style", "nav", "footer"}
SKIP_CLASSES = {"ad", "changesToParent", "footnotes", "shareArticle"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}


class Node:
    """An element of a document tree; children are elements and strings."""

    def __init__(self, tag: str, attributes: dict[str, str] | None = None):
        self.tag, self.attributes, self.children = tag, attributes or {}, []

    def classes(self) -> set[str]:
        return set(self.attributes.get("class", "").split())

    def walk(self) -> Iterator[Node]:
        todo = [self]
        while todo:
            node = todo.pop()
            yield node
            todo.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def find(self, *tags: str) -> Node | None:
        return next((n for n in self.walk() if n.tag in tags), None)

    def text(self, skip: bool = False) -> str:
        """Text with white space squeezed and blocks apart; skip leaves out navigation and the like."""
        out: list[str] = []
        todo: list[Node | str] = [self]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                out.append(x)
            elif not (skip and (x.tag in SKIP_TAGS or x.classes() & SKIP_CLASSES)) and x.tag not in ("script", "style"):
                edge = [" "] if x.tag in BLOCKS or x.tag == "br" else []
                todo += [*edge, *reversed(x.children), *edge]
        return " ".join("".join(out).split())


class _Builder(HTMLParser):
    """A tree that closes what HTML lets authors leave open."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root")
        self.open = [self.root]

    def _close(self, tags: set[str], stop: set[str]) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in tags:
                del self.open[k:]
                return
            if self.open[k].tag in stop:
                return

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self._close({"p"}, {"article", "section", "div", "td", "li", "main", "body", "aside", "footer"})
        if tag in CLOSES:
            self._close(CLOSES[tag], {"ul", "ol", "dl", "table"})
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open[-1].tag == tag:
            self.open.pop()

    def handle_endtag(self, tag):
        self._close({tag}, set())

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def links(root: Node, base: str) -> list[tuple[str, str]]:
    """(address, text) of every link, resolved against the page's own."""
    return [(urljoin(base, n.attributes["href"].strip()), n.text()) for n in root.walk() if n.tag == "a" and n.attributes.get("href")]


def markdown(root: Node) -> str:
    """Headings, paragraphs, list items, quotes and table rows as Markdown blocks."""
    out: list[str] = []

    def visit(node: Node) -> None:
        if node.tag in SKIP_TAGS or node.classes() & SKIP_CLASSES or node.tag in ("head", "title"):
            return
        if re.fullmatch("h[1-6]", node.tag):
            if t := node.text():
                out.append("#" * int(node.tag[1]) + " " + t)
        elif node.tag == "tr":
            out.append("| " + " | ".join(c.text() for c in node.children if isinstance(c, Node) and c.tag in ("td", "th")) + " |")
        elif node.tag in ("li", "blockquote", "p"):
            if t := node.text(skip=True):
                out.append({"li": "- ", "blockquote": "> "}.get(node.tag, "") + t)
        else:
            loose: list[str] = []
            for c in node.children:
                if isinstance(c, Node) and (c.tag in BLOCKS or c.tag in SKIP_TAGS or any(n.tag in BLOCKS for n in c.walk())):
                    if t := " ".join("".join(loose).split()):
                        out.append(t)
                    loose = []
                    visit(c)
                else:
                    loose.append(c if isinstance(c, str) else "" if c.tag in ("script", "style", "title") else " " + c.text() if c.tag == "br" else c.text())
            if t := " ".join("".join(loose).split()):
                out.append(t)

    visit(root)
    return "\n\n".join(out)


def metadata(root: Node) -> dict[str, str]:
    """Definition list pairs by the class of their term, the first of each."""
    found: dict[str, str] = {}
    for dl in (n for n in root.walk() if n.tag == "dl"):
        name = None
        for c in (c for c in dl.children if isinstance(c, Node)):
            if c.tag == "dt":
                name = next(iter(c.attributes.get("class", "").split()), None)
            elif c.tag == "dd" and (name := name or next(iter(c.attributes.get("class", "").split()), None)):
                found.setdefault(name, c.text())
    return found


PAGE_SCHEMA = "page_id long, url string, lang string, title string, text string, markdown string, links array<struct<href string, text string>>, unavailable boolean"
SECTION_SCHEMA = "doc_id long, ref_id string, language string, title string, section_id string, chapter_id string, paragraph_num string, section_title string, content string, position int"


def pages(rows: DataFrame) -> DataFrame:
    """page_id, url, lang, title, text, markdown, links, unavailable of pages (page_id, url, html)."""

    from . import acts

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for r in f.itertuples(index=False):
                root = parse(r.html)
                top, title = root.find("html"), root.find("title")
                out.append((r.page_id, r.url, top.attributes.get("lang", "") if top else "", title.text() if title else "", root.text(skip=True), markdown(root), [{"href": a, "text": t} for a, t in links(root, r.url or "")], acts.is_unavailable(root)))
            yield pd.DataFrame(out, columns=["page_id", "url", "lang", "title", "text", "markdown", "links", "unavailable"])

    return rows.select("page_id", "url", "html").mapInPandas(run, PAGE_SCHEMA)


def paragraphs(rows: DataFrame) -> DataFrame:
    """One row for each paragraph of sectioned documents (doc_id, html); documents without a reference id have none."""

    from . import acts

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for r in f.itertuples(index=False):
                root = parse(r.html)
                meta, top = metadata(root), root.find("html")
                if meta.get("refid"):
                    for s in acts.body(root.find("main") or root)[1]:
                        out.append((r.doc_id, meta["refid"], top.attributes.get("lang", "") if top else "", meta.get("title", ""), s["section_id"], s["chapter_id"], s["paragraph_num"], s["title"], s["content"], s["position"]))
            yield pd.DataFrame(out, columns=["doc_id", "ref_id", "language", "title", "section_id", "chapter_id", "paragraph_num", "section_title", "content", "position"])

    return rows.select("doc_id", "html").mapInPandas(run, SECTION_SCHEMA)
