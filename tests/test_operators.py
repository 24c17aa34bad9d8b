"""Operators on small fixture corpora."""

import json

import pytest
from pyspark.sql import functions as F

from statuta.operators import checks, cite, coverage, evals, graph, recon, sampling


@pytest.fixture(scope="module")
def corpus(spark):
    acts = spark.createDataFrame([("lov/2000-01-01-1", "## Kapittel\n§ 1-2 og § 9-9.\nSe forskrift/2001-06-15-599 § 2."), ("forskrift/2001-06-15-599", "Etter § 1.\n### § 7")], "key string, content string")
    paragraphs = spark.createDataFrame(
        [("lov/2000-01-01-1#p1", "lov/2000-01-01-1", "p1", "§ 1-2", 0, "Den som bryter loven straffes."), ("lov/2000-01-01-1#p2", "lov/2000-01-01-1", "p2", "§ 3", 1, "Kongen gir regler."),
         ("forskrift/2001-06-15-599#p1", "forskrift/2001-06-15-599", "p1", "§ 1", 0, "Formål."), ("forskrift/2001-06-15-599#p2", "forskrift/2001-06-15-599", "p2", "§ 2", 1, "Virkeområde.")],
        "key string, law_ref_id string, section_id string, paragraph_num string, ord int, content string",
    )
    edges = paragraphs.select(F.lit("HAS_PARAGRAPH").alias("type"), F.col("law_ref_id").alias("src_key"), F.col("key").alias("dst_key"))
    return acts, paragraphs, edges


def test_audit_totals(corpus):
    acts, paragraphs, _ = corpus
    found = cite.resolve(cite.section_citations(acts), cite.provision_index(paragraphs, ["ord"]))
    assert tuple(cite.audit(found).first()) == (4, 3, 0.75)
    assert [(r.act, r.token) for r in found.where("paragraph is null").collect()] == [("lov/2000-01-01-1", "9-9")]


def test_audit_of_nothing(corpus):
    acts, paragraphs, _ = corpus
    found = cite.resolve(cite.section_citations(acts.where("false")), cite.provision_index(paragraphs, ["ord"]))
    assert tuple(cite.audit(found).first()) == (0, 0, 0.0)


def test_targets(spark, corpus):
    _, paragraphs, _ = corpus
    wanted = spark.createDataFrame([("lov/2000-01-01-1",), ("lov/2000-01-01-1#§ 1-2",), ("lov/2000-01-01-1#p2",), ("lov/2000-01-01-1#§8",)], "ref string")
    got = sorted(tuple(r) for r in cite.targets(wanted, paragraphs).collect())
    law = "lov/2000-01-01-1"
    assert got == [(law, f"{law}#p1"), (law, f"{law}#p2"), (f"{law}#p2", f"{law}#p2"), (f"{law}#§ 1-2", f"{law}#p1")]


def test_quotes(spark, corpus):
    _, paragraphs, _ = corpus
    p = paragraphs.select(F.col("law_ref_id").alias("ref"), "key", "content")
    q = spark.createDataFrame([("lov/2000-01-01-1", "bryter  loven"), ("lov/2000-01-01-1", "Kongen gir lover")], "ref string, quote string")
    assert [r.provision for r in cite.verify_quotes(q, p).collect()] == ["lov/2000-01-01-1#p1"]
    assert {r.quote: (r.provision, r.score) for r in cite.closest(q, p).collect()}["Kongen gir lover"] == ("lov/2000-01-01-1#p2", 2)


def test_clean_corpus_has_no_violations(corpus):
    acts, paragraphs, edges = corpus
    objects = acts.select("key").union(paragraphs.select("key"))
    for found in (checks.v1_duplicate_keys(objects), checks.v2_dangling(edges, objects), checks.v3_self_loops(edges), checks.v4_structure(paragraphs, acts), checks.v5_has_paragraph(edges, paragraphs), checks.v6_ref_ids(acts.withColumn("ref_id", F.col("key")))):
        assert found.count() == 0


def test_each_violation_fires(spark, corpus):
    acts, paragraphs, edges = corpus
    objects = acts.select("key").union(paragraphs.select("key"))
    assert checks.v1_duplicate_keys(objects.union(acts.select("key"))).count() == 2
    assert checks.v2_dangling(edges, acts.select("key")).count() == 4
    loop = spark.createDataFrame([("X", "a", "a")], "type string, src_key string, dst_key string")
    assert checks.v3_self_loops(loop).count() == 1
    assert {r.detail for r in checks.v4_structure(paragraphs.withColumn("law_ref_id", F.when(F.col("section_id") == "p1", F.col("law_ref_id"))), acts).collect()} == {"empty law_ref_id"}
    assert {r.detail for r in checks.v5_has_paragraph(edges.where("dst_key like '%p1'").withColumn("src_key", F.lit("z")), paragraphs).collect()} == {"source is not the parent", "orphan paragraph"}
    assert checks.v6_ref_ids(spark.createDataFrame([("a", "lov/1"), ("b", None), ("c", "lov/1687-04-15")], "key string, ref_id string")).count() == 2
    assert [r.detail for r in checks.v7_dates(spark.createDataFrame([("a", "2023-02-30", " ")], "key string, d string, e string"), ["d", "e"]).collect()] == ["d calendar"]
    actual, manifest = spark.createDataFrame([("Law", 2), ("X", 1)], "type string, n long"), spark.createDataFrame([("Law", 3), ("Y", 1)], "type string, expected long")
    assert {r.key for r in checks.v8_counts(actual, manifest).collect()} == {"Law", "X", "Y"}


def test_first_wins_and_merge(spark):
    rows = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), ("j", 3, "c")], "key string, ord int, v string")
    assert sorted((r.key, r.v) for r in graph.dedupe_first(rows, ["key"], ["ord"]).collect()) == [("j", "c"), ("k", "a")]
    edges = spark.createDataFrame([("a", "b", 1, "x", "1"), ("a", "b", 2, "x", "2"), ("a", "b", 2, "y", "3"), ("a", "b", 0, "z", None)], "s string, t string, ord int, p string, v string")
    merged = graph.as_map(graph.merge_properties(edges, ["s", "t"], "p", "v", ["ord"]), ["s", "t"], "p", "v").first()
    assert merged.properties == {"x": "1", "y": "3"}


def test_reach(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "a string, b string")
    assert {r.node: r.depth for r in graph.reach(edges, spark.createDataFrame([("a",)], "node string"), 2).collect()} == {"a": 0, "b": 1, "c": 2}


def test_manifest_diff(spark):
    old, new = (spark.createDataFrame(x, "ref_id string, sha256 string") for x in ([("a", "1"), ("b", "1"), ("c", "1")], [("a", "1"), ("b", "2"), ("d", "1")]))
    assert {r.ref_id: r.status for r in recon.manifest_diff(old, new).collect()} == {"a": "unchanged", "b": "changed", "c": "removed", "d": "added"}


def test_property_delta_and_retype(spark):
    seed = spark.createDataFrame([("k", "2024-01-01", "x", None)], "key string, d string, n string, o string")
    live = spark.createDataFrame([("k", "2024-01-01T00:00:00Z", "y", "old")], "key string, d string, n string, o string")
    assert sorted((r.prop, r.action, r.value) for r in recon.property_delta(seed, live, ["d", "n", "o"]).collect()) == [("n", "set", "x"), ("o", "delete", None)]
    assert recon.retype_candidates(seed, live, "d").count() == 0 and recon.retype_candidates(seed, seed, "d").count() == 1


def test_coverage(spark):
    source = spark.createDataFrame([(1, "a a b"), (2, ""), (3, "x")], "id int, text string")
    model = spark.createDataFrame([(1, "a b"), (3, "x x")], "id int, text string")
    rows = coverage.token_recall(source, model, "id")
    assert {r.id: (r.total, r.kept, round(r.coverage, 3)) for r in rows.collect()} == {1: (3, 2, 0.667), 2: (0, 0, 1.0), 3: (1, 1, 1.0)}
    assert tuple(coverage.summary(rows.where("false")).first()) == (0, 0.0, 0.0, 0, 0)


def test_even_spread(spark):
    rows = spark.range(10).withColumnRenamed("id", "k")
    assert sorted(r.k for r in sampling.even_spread(rows, ["k"], 4).collect()) == [0, 2, 5, 7]
    assert sampling.even_spread(rows, ["k"], 20).count() == 10
    assert sampling.split_answerable(0, 0.5) == (0, 0) and sampling.split_answerable(5, 0.5) == (3, 2)


def test_abbreviations(spark):
    laws = spark.createDataFrame([("lov/b", "Straffeloven – strl.", "Lov om straff (straffeloven)"), ("lov/a", "Lov om endring", "Lov om endringer i straffeloven"), ("lov/c", "strl", "Lov")], "key string, short_title string, name string")
    got = {r.token: r.key for r in evals.abbreviations(laws).collect()}
    assert got["straffeloven"] == "lov/b" and got["strl"] == "lov/c" and "lov" not in got


def test_grouping_sets_report(spark):
    rows = spark.createDataFrame([("", "easy", True, 1.0, 1.0, 1.0, 1.0, None, None), ("x", "hard", False, 0.0, 0.0, 0.0, 0.0, None, True)], "area string, difficulty string, answerable boolean, f1 double, recall double, precision double, resolution_rate double, point_recall double, refusal_correct boolean")
    got = {r.grouping: (r["items"], r.f1, r.point_recall, r.refusals, r.refusals_correct) for r in evals.report(rows).collect()}
    assert got["overall"] == (1, 1.0, None, 1, 1) and got["area=unknown"] == (1, 1.0, None, 0, 0) and got["difficulty=hard"] == (0, 0.0, None, 1, 1)


def test_dump_and_read_back(spark, tmp_path, corpus):
    from statuta.sources import files, sinks

    acts, paragraphs, edges = corpus
    objects = acts.select(F.lit("Law").alias("type"), "key", F.create_map(F.lit("content"), "content").alias("properties")).unionByName(
        paragraphs.select(F.lit("LegalParagraph").alias("type"), "key", F.create_map(F.lit("section_id"), "section_id").alias("properties"))
    ).withColumn("ord", F.monotonically_increasing_id())
    full = edges.union(edges.limit(1)).withColumn("ord", F.lit(0)).union(spark.createDataFrame([("REFERENCES", "lov/x", "lov/y", 0)], "t string, a string, b string, o int"))
    made = sinks.dump(objects, full.dropDuplicates(["type", "src_key", "dst_key"]), str(tmp_path / "seed"))
    assert made["counts"] == {"objects": 6, "relationships": 4, "by_type": {"HAS_PARAGRAPH": 4, "Law": 2, "LegalParagraph": 4}}
    back = files.objects(spark, str(tmp_path / "seed/objects/*/*.json"))
    assert back.count() == 6 and files.relationships(spark, str(tmp_path / "none/*.json")).count() == 0
    assert back.select(files.lenient(F.col("properties"), "section_id").alias("s")).where("s = 'p1'").count() == 2
    with pytest.raises(sinks.GateError):
        sinks.dump(objects, full, str(tmp_path / "no"), coverage=spark.createDataFrame([(0.5,)], "coverage double"), least=0.9)
    assert not (tmp_path / "no").exists()
    sinks.write_manifest(objects, made, str(tmp_path / "m"))
    text = "\n".join(r[0] for r in spark.read.option("wholetext", True).text(str(tmp_path / "m")).collect())
    assert json.loads(text) == made


def test_sources(spark, tmp_path):
    import io
    import tarfile

    from statuta.sources import files

    with tarfile.open(tmp_path / "a.tar.bz2", "w:bz2") as t:
        for name, body in (("x/1.xml", b"<a/>"), ("x/skip.txt", b"no"), ("x/2.xml", b"<b/>")):
            info = tarfile.TarInfo(name)
            info.size = len(body)
            t.addfile(info, io.BytesIO(body))
    assert [(r.member, r.ord, r.content) for r in files.archive_members(spark, str(tmp_path / "a.tar.bz2")).orderBy("ord").collect()] == [("x/1.xml", 0, "<a/>"), ("x/2.xml", 1, "<b/>")]
    result = json.dumps({"results": {"bindings": [{"c": {"type": "l", "value": "1"}, "t": {"type": "l", "value": "b"}}, {"c": {"type": "l", "value": "1"}, "t": {"type": "l", "value": "a"}}]}})
    rows = files.bindings(spark.createDataFrame([(result,)], "value string"))
    assert [(r.c, r.t) for r in files.collapse(rows, "c", [], ["t"]).collect()] == [("1", ["a", "b"])]
    index = files.publications(spark.createDataFrame([(0, '[{"id":"INNS-1","tittel":"Innst. 80"}]'), (1, '{"id":"inns-1","tittel":"Innst. 080 ny"}')], "ord int, value string"))
    assert [(r.id, r.title) for r in index.collect()] == [("inns-1", "Innst. 080 ny")]
    slugs = spark.createDataFrame([("s", "80", ["x", "inns-1"]), ("t", "8", ["inns-1"])], "slug string, number string, candidates array<string>")
    assert [tuple(r) for r in files.match_publications(slugs, index).collect()] == [("s", "inns-1")]
    (tmp_path / "pack.yaml").write_text("objectTypes:\n  - name: Law\n    properties:\n  - name: Ministry\nrelationshipTypes:\n  - name: AMENDS\n")
    assert sorted(tuple(r) for r in files.declared_types(spark, str(tmp_path / "pack.yaml")).collect()) == [("objectTypes", "Law"), ("objectTypes", "Ministry"), ("relationshipTypes", "AMENDS")]


def test_documents(spark):
    from statuta.sources import pages

    html = """<html lang="nb"><head><title>x</title></head><body><header><dl><dt class="refid">Ref</dt><dd>lov/2005-06-17-62</dd></dl></header>
      <main id="dokument"><section id="kapittel-1"><h2>Kapittel 1. Om</h2><h3>II</h3>
      <article class="legalArticle" id="p1"><h4 class="legalArticleHeader"><span class="legalArticleValue">§ 1-1</span> <span class="legalArticleTitle">Formål</span></h4><article class="legalP" id="p1l1">Loven gjelder.</article></article>
      <section id="under"><article class="legalP" id="u1">Indre</article></section><article class="legalP" id="k2">Ytre <b>tekst</b></article><article class="legalP" id="tom"></article></section></main></body></html>"""
    rows = pages.paragraphs(spark.createDataFrame([(1, html), (2, "<p>uten"), (3, None)], "doc_id long, html string")).orderBy("position").collect()
    assert [(r.section_id, r.chapter_id, r.paragraph_num, r.section_title, r.content, r.position) for r in rows] == [("p1", "kapittel-1", "§ 1-1", "Formål", "### § 1-1 — Formål\n\nLoven gjelder.", 1), ("u1", "under", "", "", "Indre", 2), ("k2", "kapittel-1", "", "", "Ytre tekst", 3)]
    page = pages.parse('<p>En<br>to<p><b>tre<ul><li>a<li>b</ul><script>var t="</p>"</script><a href="../x">l</a>')
    assert page.text() == "En to tre a b l" and pages.links(page, "https://e.no/a/b/")[0] == ("https://e.no/a/x", "l")
