"""Records of a small corpus: every type, no dangling ends, first record wins."""

import pytest
from pyspark.sql import functions as F

from statuta.operators import build, graph

META = {"32009L0103": ("Loven gjennomfører direktivet.", "gjennomfører", ["6", "6.1.a"])}


def doc(ord_, ref, **more):
    base = dict.fromkeys([c.split()[0] for c in ("ref_id doc_id legacy_id title short_title language doc_type ministry legal_area legal_areas legal_sub_areas amends see_also references celex eu_body works work_names "
        "date_in_force last_change_in_force date_of_publication applies_to last_changed_by eea_references content content_unavailable paragraphs eea_meta eu_body_meta ord").split()])  # fmt: skip
    lists = {c: [] for c in ("legal_areas", "legal_sub_areas", "amends", "see_also", "references", "celex", "eu_body", "works", "paragraphs")}
    return base | lists | {"work_names": {}, "eea_meta": {}, "eu_body_meta": {}, "ref_id": ref, "title": f"Lov {ref}", "doc_type": "law", "content": "", "content_unavailable": False, "ord": ord_} | more


@pytest.fixture(scope="module")
def corpus(spark):
    a = doc(
        0, "lov/2005-06-17-62", doc_id="D1", language="nb", ministry="AID", legal_area="Arbeid", legal_areas=["Arbeid"], legal_sub_areas=["Vern"], see_also=["lov/2000-01-01-1", "lov/none"], references=["lov/none"],
        celex=["32009l0103", "32099L0001"], eu_body=["32014L0040", "32014L0040"], works=["otprp-49-200405"], work_names={"otprp-49-200405": "Ot.prp. 49"}, date_in_force="01.01.2006", last_changed_by="lov/2000-01-01-1",
        last_change_in_force="2020-01-01", eea_meta=META, paragraphs=[("p1", "k1", "§ 1", "Formål", "Endret ved lov 14 juni 2024 nr. 20", 1), ("kapittel-2-ledd-1", None, None, None, "Tekst", 2), ("", "", "", "", "uten id", 3), ("p4", "", "", "", "Ny lydelse skal lyde:", 4)],
    )
    b = doc(1, "lov/2000-01-01-1", doc_id="D1", language="nn", ministry="AID", legal_sub_areas=["Vern"], legal_area="Annet", amends=["lov/2005-06-17-62"], date_in_force="Kongen bestemmer", works=["otprp-49-200405"], work_names={"otprp-49-200405": "Annet navn"}, content_unavailable=True)
    docs = spark.createDataFrame([a, b], build.DOCUMENT)
    acts = spark.createDataFrame([("32009L0103", "", "Lang tittel", None, "2009-09-16", None, ["A", "B"], [], [], True, "x", ["31972L0166"], [], ["8469"])], build.EU_ACT)
    concepts = spark.createDataFrame([("8469", "insurance")], "id string, label string")
    objects = build.objects(docs, acts, concepts, "2024-07-08").cache()
    return docs, acts, objects, build.relationships(docs, acts, objects).cache()


def test_objects(corpus):
    _, _, objects, _ = corpus
    got = {r.key: (r.type, r.properties) for r in objects.collect()}
    kinds = sorted(t for t, _ in got.values())
    assert kinds == sorted(["Ministry", "LegalArea", "LegalArea", "Law", "Law", *["LegalParagraph"] * 3, *["Amendment"] * 2, "ProvisionVersion", *["EUDirective"] * 3, "EuroVocConcept", "PreparatoryWork"])
    law = got["lov/2005-06-17-62"][1]
    assert law["date_in_force"] == "2006-01-01" and law["year_in_force"] == "2006" and law["decade_in_force"] == "2000s" and law["publisher"] == "Lovdata" and "legacy_id" not in law
    assert got["lov/2000-01-01-1"][1]["date_in_force_raw"] == "Kongen bestemmer" and got["lov/2000-01-01-1"][1]["content_unavailable"] == "true"
    assert got["subarea_Vern"][1]["parent_area"] == "Arbeid" and got["forarbeid/otprp-49-200405"][1]["name"] == "Ot.prp. 49"
    assert got["lov/2005-06-17-62#kapittel-2-ledd-1"][1]["section_label"] == "Kapittel 2, ledd 1" and got["lov/2005-06-17-62#p1"][1]["name"] == "§ 1 Formål"
    assert got["eu_32009L0103"][1]["author"] == "A; B" and got["eu_31972L0166"][1]["name"] == "31972L0166"


def test_relationships(corpus):
    _, _, objects, edges = corpus
    got = {}
    for r in edges.collect():
        got.setdefault(r.type, []).append((r.src_key, r.dst_key, r.properties or {}))
    assert {k: len(v) for k, v in got.items()} == {
        "ADMINISTERED_BY": 2, "IN_LEGAL_AREA": 3, "AMENDS": 1, "SEE_ALSO": 1, "IMPLEMENTS_EEA": 1, "PREPARES": 2, "HAS_PARAGRAPH": 3, "CITES_EU_LAW": 1, "AMENDED_BY": 1, "HAS_AMENDMENT": 2, "HAS_VERSION": 1,
        "HAS_LANGUAGE_VARIANT": 1, "EU_CITES": 1, "HAS_EUROVOC_DESCRIPTOR": 1,
    }
    (implements,) = got["IMPLEMENTS_EEA"]
    assert implements[2]["reference_type"] == "implements" and implements[2]["is_primary"] == "true" and implements[2]["eu_articles"] == "6,6.1.a"
    assert got["CITES_EU_LAW"][0][2]["reference_type"] == "cites_article" and got["AMENDED_BY"][0][2]["effective_date"] == "2020-01-01"
    assert graph.endpoint_filter(edges, objects).count() == edges.count()


def test_manifest_and_derivation(spark, corpus):
    docs, _, objects, edges = corpus
    m = build.manifest(docs, objects, edges, spark.createDataFrame([(1.0,), (0.97,)], "coverage double")).first()
    assert m.objects == objects.count() and m.relationships == edges.count() and m.unavailable == ["lov/2000-01-01-1"] and m.below_99 == 1 and sorted(m.documents) == ["lov/2000-01-01-1", "lov/2005-06-17-62"]
    works = spark.createDataFrame([("a", True, ["b", "a", "z"]), ("b", False, ["a"])], "slug string, available boolean, sources array<string>")
    assert [tuple(r) for r in build.derived_from(works).collect()] == [("a", "b")]
    rows = build.current(spark.createDataFrame([("k", 1), ("k", 2)], "k string, v int"), "k", "v")
    assert [(r.v, r.is_current) for r in rows.orderBy(F.col("v")).collect()] == [(1, False), (2, True)]


def test_no_plan_lacks_columns(spark):
    """A generator of a column that all documents lack loses no columns of its input, which fails where tables are too large to broadcast."""
    from statuta.plans import records

    sf = "/root/testdata/sf0.001"
    docs, (acts, concepts) = records._documents(spark, sf), records._eu(spark, sf)
    eu = build.objects(docs, acts, concepts, "2024-07-08").where("key like 'eu%'")
    versions = build.relationships(docs, acts, docs.select(F.col("ref_id").alias("key"))).where("type = 'HAS_VERSION'")
    for d in (eu, versions, records.built_eu_objects(spark, sf)):
        assert not any(x.lstrip(" :+-").startswith("!") for x in d._jdf.queryExecution().optimizedPlan().toString().splitlines())
