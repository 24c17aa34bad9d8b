from statuta.operators import build, coverage
from statuta.sources import legal

HTML = """<html lang="nn"><body><header><dl><dt class="refid">R</dt><dd>lov/2005-06-17-62</dd><dt class="dokid">D</dt><dd>NL/x</dd><dt class="title">T</dt><dd>Lov om arbeid</dd>
 <dt class="dateInForce">I</dt><dd>2006-01-01</dd><dt class="appliesTo">G</dt><dd>Gjelder for Norge</dd><dt class="eeaReferences">E</dt><dd>Loven gjennomfører direktiv 2009/103/EF artikkel 6.1.a; se forordning (EF) nr. 469/2009.</dd>
 <dt class="ministry">M</dt><dd><ul><li>AID<li>JD</ul></dd><dt class="legalArea">O</dt><dd><a href="/omrade/1">Arbeid</a><a href="/omrade/1.2">Vern</a></dd><dt class="lastChangedBy">L</dt><dd><a href="/lov/2020-01-01-1 fra 2021">x</a></dd>
 <dt class="changesToDocuments">C</dt><dd><a href="/lov/1999-01-01-1#a">x</a><a href="/annet">y</a></dd><dt class="miscInformation">S</dt><dd><a href="lov/1998-01-01-1">x</a></dd></dl></header>
 <main id="dokument"><section id="k1"><h2>Kapittel 1</h2><article class="legalP" id="p1">Noe. Loven gjennomfører <a href="/eu/32014l0040#a">direktiv 2014/40/EU</a> artikkel 7, jf. <a href="/lov/1990-01-01-1/§2">loven</a>, <a href="res/2001-02-03-4">vedtaket</a> og <a href="/forarbeid/otprp-49-200405/kap1">Ot.prp. 49</a>. Mer.</article></section></main></body></html>"""


def test_document(spark):
    rows = spark.createDataFrame([("law", 0, HTML), ("law", 1, "<p>uten"), ("law", 2, None)], "doc_type string, ord int, html string")
    (d,) = legal.documents(rows).collect()
    assert (d.ref_id, d.doc_id, d.title, d.language, d.applies_to, d.ministry, d.legal_areas, d.legal_sub_areas) == ("lov/2005-06-17-62", "NL/x", "Lov om arbeid", "nn", "Norge", "AID", ["Arbeid"], ["Vern"])
    assert (d.last_changed_by, d.amends, d.see_also, d.references, d.works, d.work_names) == ("lov/2020-01-01-1", ["lov/1999-01-01-1"], ["lov/1998-01-01-1"], ["lov/1990-01-01-1/§2", "res/2001-02-03-4"], ["otprp-49-200405"], {"otprp-49-200405": "Ot.prp. 49"})
    assert d.celex == ["32009L0103", "32009R0469"] and d.eea_meta["32009L0103"].keyword == "gjennomfører" and d.eea_meta["32009L0103"].articles == ["6.1.a"] and d.eu_body == ["32014L0040"]
    assert d.eu_body_meta["32014L0040"].keyword == "gjennomfører" and d.eu_body_meta["32014L0040"].articles == ["7"] and d.eu_body_meta["32014L0040"].context.startswith("Loven gjennomfører")
    assert [(p.section_id, p.chapter_id, p.position) for p in d.paragraphs] == [("p1", "k1", 1)]


def test_coverage_and_records(spark):
    docs = legal.documents(spark.createDataFrame([("law", 0, HTML)], "doc_type string, ord int, html string"))
    source = docs.selectExpr("ref_id", "source_text as text")
    assert [r.coverage for r in coverage.token_recall(source, legal.model_text(docs), "ref_id").collect()] == [1.0]
    acts, concepts = spark.createDataFrame([], build.EU_ACT), spark.createDataFrame([], "id string, label string")
    kinds = {r.type for r in build.objects(docs, acts, concepts, "2024-07-08").collect()}
    assert kinds == {"Ministry", "LegalArea", "Law", "LegalParagraph", "EUDirective", "PreparatoryWork", "Amendment"}
