"""The body of a marked-up act: Markdown, its paragraphs as rows, and the clauses around links to EU acts."""

from __future__ import annotations

import re
from collections.abc import Iterator

from .pages import Node

# Classes by what an element is. An element's class is its whole attribute.
SKIPPED = {"changesToParent", "footnotes", "tocSubUl"}
ARTICLES = {"legalArticle", "futureLegalArticle"}
HEADERS = {"legalArticleHeader", "futureLegalArticleHeader"}
PARAGRAPHS = {"legalP", "numberedLegalP", "defaultP", "centeredP"}
UNAVAILABLE_CLASS, UNAVAILABLE_TEXT = "errorMessage", "klarer dessverre ikke vise hele dokumentet"
# Headings that are no chapter titles. A Roman numeral alone divides; a part keeps its title.
ROMAN = re.compile(r"(?i)^(?=.)M{0,4}(CM|CD|D?C{0,3})(XC|XL|L?X{0,3})(IX|IV|V?I{0,3})$")
ORDINALS = "første andre tredje fjerde femte sjette sjuende syvende åttende niende tiende ellevte tolvte".split()
PART = re.compile(rf"(?i)^(?:(?:{'|'.join(ORDINALS)})\s+)?del(?:en)?(?![a-zæøå])")


def kind(node: Node) -> str:
    return node.attributes.get("class", "")


def pieces(node: Node) -> Iterator[tuple[Node | None, str]]:
    """The text of an element as (None, text), and (element, "") where an element begins; skipped elements are left out."""
    todo: list = [node]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            yield None, x
        elif kind(x) not in SKIPPED:
            yield x, ""
            todo.extend(reversed(x.children))


def plain(node: Node) -> str:
    return "".join(t for _, t in pieces(node)).strip()


def elements(node: Node) -> list[Node]:
    return [c for c in node.children if isinstance(c, Node)]


def is_unavailable(root: Node) -> bool:
    """Whether a page stands in for a document that can't be shown."""
    if any(kind(n) == UNAVAILABLE_CLASS for n in root.walk()):
        return True
    todo, text = [root], []
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            text.append(x)
        else:
            todo.extend(reversed(x.children))
    return UNAVAILABLE_TEXT in "".join(text).lower()


def heading(section: Node) -> str:
    """The Markdown heading of a section; empty where there is none to give."""
    name = section.attributes.get("id", "")
    number = name.rsplit("-", 1)[1] if "-" in name else ""
    title = next((plain(c) for c in elements(section) if c.tag in ("h1", "h2")), "")
    if title.removesuffix(".") and ROMAN.match(title.removesuffix(".")) or not (number or title):
        return ""
    if title.lower().startswith("kapittel") or PART.match(title):
        return f"## {title}"
    return f"## Kapittel {number}" + (f". {title}" if title else "")


def items(node: Node) -> str:
    """The items of a list, each on its line; those of a numbered list have numbers."""
    texts = [t for c in elements(node) if c.tag == "li" and (t := plain(c))]
    return "".join(f"{f'{k}.' if node.tag == 'ol' else '-'} {t}\n" for k, t in enumerate(texts, 1))


def _part(node: Node) -> str:
    """One element of an article's content."""
    name = kind(node)
    if name in SKIPPED or name in HEADERS:
        return ""
    if name == "listArticle":
        return f"- {t}\n" if (t := plain(node)) else ""
    if node.tag in ("ol", "ul") and name not in PARAGRAPHS:
        return items(node)
    return f"{t}\n\n" if (t := plain(node)) else ""


def _title(article: Node) -> tuple[str, str]:
    """Number and title of an article, from the first header among its children."""
    header = next((c for c in elements(article) if kind(c) in HEADERS), None)
    spans = [n for n in header.walk() if n.tag == "span"] if header else []
    return tuple(next((t for n in spans if kind(n) == name and (t := plain(n))), "") for name in ("legalArticleValue", "legalArticleTitle"))


def body(main: Node) -> tuple[str, list[dict]]:
    """Markdown of an act, and its paragraphs: section_id, chapter_id, paragraph_num, title, content, position.

    Articles, and body paragraphs outside them, are paragraphs; those without id or text give no row but keep their position. The
    chapter of a paragraph is the id of the section around it.
    """
    out: list[str] = []
    rows: list[dict] = []
    position, todo = 0, [(c, "") for c in reversed(elements(main))]
    while todo:
        node, chapter = todo.pop()
        name, id_ = kind(node), node.attributes.get("id", "")
        if name in SKIPPED:
            continue
        if node.tag == "article" and name in ARTICLES | PARAGRAPHS:
            position += 1
            if name in ARTICLES:
                number, title = _title(node)
                head = " — ".join(x for x in (number, title) if x)
                text = (f"### {head}\n\n" if head else "") + "".join(_part(c) for c in elements(node))
            else:
                number, title, text = "", "", f"{t}\n\n" if (t := plain(node)) else ""
            out.append(text)
            if text.strip() and id_:
                rows.append({"section_id": id_, "chapter_id": chapter, "paragraph_num": number, "title": title, "content": text.strip(), "position": position})
        elif node.tag in ("ol", "ul"):
            out.append(items(node))
        else:
            if node.tag == "section":
                chapter = id_
                if head := heading(node):
                    out.append(f"\n{head}\n\n")
            todo += [(c, chapter) for c in reversed(elements(node))]
    return "".join(out).strip(), rows


def eu_links(main: Node) -> list[dict]:
    """code, left, ref, right of the first link to each EU act: the text of the article around it, or of the whole body outside articles,
    before the link, of the link and after it; texts are empty for a link in a skipped element."""
    found: dict[str, dict] = {}

    def collect(scope: Node) -> None:
        text, at, size = [], {}, 0
        for n, t in pieces(scope):
            if n is not None:
                at[id(n)] = size
            text.append(t)
            size += len(t)
        whole = "".join(text)
        for a in scope.walk():
            href = a.attributes.get("href", "").removeprefix("/").split("#")[0] if a.tag == "a" else ""
            if href.startswith("eu/") and len(href) > 3 and (code := href[3:].upper()) not in found:
                begin = at.get(id(a))
                end = begin + sum(len(t) for _, t in pieces(a)) if begin is not None else None
                found[code] = {"code": code, "left": whole[:begin] if end else "", "ref": whole[begin:end] if end else "", "right": whole[end:] if end else ""}

    todo = list(reversed(elements(main)))
    while todo:
        n = todo.pop()
        if kind(n) in SKIPPED:
            continue
        if n.tag == "article" and kind(n) in ARTICLES | PARAGRAPHS:
            collect(n)
        else:
            todo += reversed(elements(n))
    collect(main)
    return [found[c] for c in sorted(found)]
