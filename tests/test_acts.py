"""Bodies of marked-up acts. Headings and classes, and what must come out of them."""

import pytest

from statuta.sources import acts, pages


def body(inner):
    return acts.body(pages.parse(f'<main id="dokument">{inner}</main>').find("main"))


def chapter(title, id_="kapittel-1"):
    return body(f'<section class="section" id="{id_}"><h2>{title}</h2><article class="legalP" id="l1">Tekst.</article></section>')[0]


@pytest.mark.parametrize("title, want", [
    ("Kapittel 1. Innledende bestemmelser", "## Kapittel 1. Innledende bestemmelser"), ("Virkeområde", "## Kapittel 1. Virkeområde"), ("Del I. Innledende bestemmelser", "## Del I. Innledende bestemmelser"),
    ("Første delen. Sluttføresegner", "## Første delen. Sluttføresegner"), ("Andre delen – vidaregåande opplæring", "## Andre delen – vidaregåande opplæring"), ("Delegering", "## Kapittel 1. Delegering"),
    ("Delårsregnskap", "## Kapittel 1. Delårsregnskap"), ("Deling av foretak m.v.", "## Kapittel 1. Deling av foretak m.v."), (".", "## Kapittel 1. ."), ("", "## Kapittel 1"),
])
def test_chapter_headings(title, want):
    assert chapter(title) == f"{want}\n\nTekst."


@pytest.mark.parametrize("title", ["I", "II.", "iv", "XIX"])
def test_numerals_are_no_chapters(title):
    assert chapter(title) == "Tekst."


@pytest.mark.parametrize("name, header", [("legalArticle", "h3 class=legalArticleHeader"), ("legalArticle", "h4 class=legalArticleHeader"), ("futureLegalArticle", "span class=futureLegalArticleHeader")])
def test_articles_of_both_vintages(name, header):
    text, rows = body(f'<article class="{name}" id="a3"><{header}><b><span class="legalArticleValue">§ 3-2</span></b>. <span class="legalArticleTitle">Indeks</span></{header.split()[0]}>'
                      '<article class="legalP">Ett <i>ledd</i>.</article><div class="changesToParent">Endret.</div><article class="listArticle">a</article><article class="listArticle">b</article><ol><li>x<li></li><li>y</ol></article>')  # fmt: skip
    assert text == "### § 3-2 — Indeks\n\nEtt ledd.\n\n- a\n- b\n1. x\n2. y"
    assert rows == [{"section_id": "a3", "chapter_id": "", "paragraph_num": "§ 3-2", "title": "Indeks", "content": text, "position": 1}]


def test_chapters_end_with_their_section():
    _, rows = body('<section id="kapittel-1"><h2>Kapittel 1</h2><section id="kapittel-1-del-1"><h2>Del 1</h2><article class="legalP" id="a">Indre.</article></section><article class="legalP" id="b">Ytre.</article></section>'
                   '<section><article class="defaultP" id="c">Uten.</article></section><article class="legalArticle"><article class="legalP" id="d">I artikkel uten id.</article></article><article class="centeredP" id="e">Sist.</article>')  # fmt: skip
    assert [(r["section_id"], r["chapter_id"], r["position"]) for r in rows] == [("a", "kapittel-1-del-1", 1), ("b", "kapittel-1", 2), ("c", "", 3), ("e", "", 5)]


def test_unavailable_documents():
    assert acts.is_unavailable(pages.parse('<div class="errorMessage">x</div>')) and acts.is_unavailable(pages.parse("<p>Vi Klarer dessverre ikke <b>vise hele dokumentet</b> nå</p>"))
    assert not acts.is_unavailable(pages.parse('<p class="unavailable"></p>')) and not acts.is_unavailable(pages.parse(""))


def test_eu_links():
    root = pages.parse('<main><article class="legalArticle" id="a">Før. Etter <a href="/eu/32014l0040">direktivet</a> gjelder; mer <a href="eu/32014l0040#x">igjen</a>.</article>'
                       '<p>Ute <a href="/eu/32009r0469">her</a>.</p><div class="footnotes"><a href="/eu/32001l0001">note</a></div><a href="/eu/">tom</a></main>').find("main")  # fmt: skip
    got = {x["code"]: (x["left"], x["ref"], x["right"]) for x in acts.eu_links(root)}
    assert got["32014L0040"] == ("Før. Etter ", "direktivet", " gjelder; mer igjen.") and got["32009R0469"][1] == "her" and got["32001L0001"] == ("", "", "") and len(got) == 3
