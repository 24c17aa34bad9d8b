"""Bodies and fields of EU acts, publications of the parliament. Marks and labels, and what must come out of them."""

import hashlib

from pyspark.sql import functions as F

from statuta.functions import eu
from statuta.sources import eu_bodies, parliament

FILL = " " * 1000
JOURNAL = """<html><body><p class="oj-hd-lg">EN</p><div class="eli-main-title"><p class="oj-normal">Title</p></div><div id="pbl_1"><p class="oj-normal">preamble</p></div>
<div class="eli-subdivision" id="rct_1"><table><tr><td>(1)</td><td>Whereas  this.</td></tr></table></div><div class="eli-subdivision" id="cit_1"><p class="oj-normal">cited</p></div>
<div class="eli-subdivision" id="art_1"><p class="oj-ti-art">Article 1</p><div class="eli-title"><p class="oj-sti-art">Scope</p></div><p class="oj-normal">This <span>applies</span>.</p><table><tr><td>(a)</td><td>a longer item here</td></tr></table></div>
<div class="eli-subdivision" id="art_2"><p class="oj-ti-art">Article 2</p><p class="oj-normal"> End. </p></div><div class="oj-final"><p class="oj-normal">Done at</p></div><p class="oj-note">note</p></body></html>"""


def test_journal_body():
    assert eu_bodies.journal_body(JOURNAL) == "(1) (1)Whereas this.\n\n## Article 1 — Scope\n\nThis applies.\n\na longer item here\n\n## Article 2\n\nEnd."
    assert eu_bodies.journal_body("") == ""


def test_legacy_body():
    assert eu_bodies.legacy_body("<html>x<TXT_TE><h2>One</h2><p>a  <b>b</b></p><br><p></p><p>c</TXT_TE><p>after") == "## One\n\na b\n\n\nc"
    assert eu_bodies.legacy_body('<div id="TexteOnly"><p>only</p></div><p>after') == "only" and eu_bodies.legacy_body("<p>none") == ""


def test_formex_body(spark):
    xml = "<ACT><ARTICLE ID='1'><TI.ART>Article <B>1</B></TI.ART><STI.ART>Scope</STI.ART><ALINEA>This\napplies <X/>now.</ALINEA><P>abc</P></ARTICLE><ARTICLE><ALINEA>Without a number</ALINEA></ARTICLE></ACT>"
    assert spark.createDataFrame([(xml,)], "b string").select(eu_bodies.formex_body(F.col("b"))).first()[0] == "## Article 1 — Scope\n\nThis applies now.\n\n## Article\n\nWithout a number"


def test_choice_of_the_part(spark):
    french, english = JOURNAL.replace(">EN<", ">FR<") + FILL, JOURNAL + FILL
    formex, legacy = "<ACT><ARTICLE><ALINEA>Some text</ALINEA></ARTICLE></ACT>" + FILL, "<html><TXT_TE><p>old</p></TXT_TE>" + FILL
    rows = [("a", 3, french), ("a", 5, english), ("a", 4, formex), ("b", 4, french), ("b", 3, formex), ("c", 1, legacy), ("c", 3, JOURNAL[:400]), ("d", 3, "<html>" + FILL), ("e", 1, legacy), ("e", 7, french), ("f", 3, None)]
    parts = spark.createDataFrame(rows, "id string, seq int, body string")
    best = eu_bodies.chosen(parts)
    assert {r.id: (r.format, r.body) for r in best.collect()} == {"a": ("oj", english), "b": ("formex", formex), "c": ("legacy", legacy), "e": ("oj", french)}
    got = {r.id: r.content for r in eu_bodies.bodies(best).collect()}
    assert got["b"] == "## Article\n\nSome text" and got["c"] == "old" and got["a"].endswith("## Article 2\n\nEnd.")


def test_metadata_page(spark):
    html = """<meta name="WT.z_docTitle" content="Directive 2003/1/EC of the Council (text with relevance)"><a href="http://eurovoc.europa.eu/12">x</a><a href="http://eurovoc.europa.eu/12">y</a>
      <table><tr><th>Date of document:</th><td>14/02/2003</td><td>later</td></tr><tr><th>Date of effect: </th><td>01/03/2003; see note</td></tr><tr><th>Author</th><td>Council  X</td></tr>
      <tr><th>Instruments cited</th><td>31999L0001 and 31999L0001</td><td>32000R0002</td></tr></table><p>OJ L 41, 14.2.2003, p. 26<br>"""
    got = eu_bodies.metadata(spark.createDataFrame([("a", html), ("b", None)], "id string, html string"))
    a, b = (got.where(F.col("id") == i).first() for i in "ab")
    assert (a.full_title, a.short_title, a.date_of_document, a.date_of_effect, a.author, a.cited_celex, a.eurovoc_ids, a.oj_reference) == (
        "Directive 2003/1/EC of the Council (text with relevance)", "Directive 2003/1/EC of the Council", "14/02/2003", "01/03/2003", ["Council X"], ["31999L0001", "32000R0002"], ["12"], "OJ L 41, 14.2.2003, p. 26")
    assert b.full_title == "" and b.author == []
    query = spark.createDataFrame([("b", "from the query")], "id string, full_title string")
    assert {r.id: r.full_title for r in eu_bodies.merged(query, got).collect()} == {"a": a.full_title, "b": "from the query"}


def test_journal_references(spark):
    rows = spark.createDataFrame([("oj:JOL_2003_041_R_0026_01", "2003-02-14"), ("oj:JOC_2003_000_R_0001_01", ""), ("JOL_2003_041_R_0026_01", None), ("other", "2003-02-14"), ("oj:XOL_1_2_3_4", "x")], "d string, t string")
    assert [r[0] for r in rows.select(eu.journal_reference(F.col("d"), F.col("t"))).collect()] == ["OJ L 41, 14.2.2003, p. 26", "OJ C 2003, 2003, p. 1", "OJ L 41, 2003, p. 26", "", ""]
    uris = spark.createDataFrame([("http://eurovoc.europa.eu/2470",), ("http://eurovoc.europa.eu/2470//",), ("x",)], "u string")
    assert [r[0] for r in uris.select(eu.concept_suffix(F.col("u"))).collect()] == ["2470", "2470", "x"]


XML = """<Innstilling><tit>Om  lov</tit><kapittel><stikktittel>Ett</stikktittel><a>Komiteen <i>viser</i> til.</a><sitat>linje en
linje to</sitat><table><row><entry>a</entry><entry>b</entry></row><row><entry>c</entry></row><row></row></table><kildedok>Prop. 158 L (2024–2025)</kildedok><uttal></uttal></kapittel></Innstilling>"""


def test_publications_of_the_parliament(spark):
    assert parliament.markdown(XML) == "### Om  lov\n\n### Ett\n\nKomiteen viser til.\n\n> linje en\n> linje to\n\n| a | b |\n| c |\n\nProp. 158 L (2024–2025)" and parliament.markdown("") == ""
    texts = parliament.publications(spark.createDataFrame([("inns-2024-080", XML), ("inns-2024-081", " "), ("x", None)], "id string, xml string"))
    index = spark.createDataFrame([("inns-2024-080", "Innst. 80 L"), ("inns-2024-081", "Innst. 81 L")], "id string, title string")
    works = spark.createDataFrame([("inns-80-l-2024", "innstilling", "80", ["none", "inns-2024-080"]), ("inns-81-l-2024", "innstilling", "81", ["inns-2024-081"]), ("inns-9", "innstilling", "9", ["nope"])], "slug string, prep_type string, number string, candidates array<string>")
    rows = parliament.enriched(works, index, texts)
    got = {r.slug: r for r in rows.collect()}
    a, b, c = got["inns-80-l-2024"], got["inns-81-l-2024"], got["inns-9"]
    assert (a.stortinget_id, a.title, a.content_available, a.source, a.source_hash, a.derives_from) == ("inns-2024-080", "Innst. 80 L", True, "stortinget", hashlib.sha256(XML.encode()).hexdigest(), ["prop-158-l-202425"])
    assert (b.content_available, b.source, b.matched) == (False, "lovdata-ref", True) and (c.matched, c.source_url, c.derives_from) == (False, "https://lovdata.no/forarbeid/inns-9", [])
    assert [tuple(r) for r in parliament.statistics(rows).collect()] == [("innstilling", 1, 1, 1)]
