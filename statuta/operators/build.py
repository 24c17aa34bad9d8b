"""Object and relationship records of a corpus: one select for each type, joined by union, first record of a key wins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statuta.functions import dates, eu, prep, text

from . import graph

EU_META = "map<string, struct<context string, keyword string, articles array<string>>>"
DOCUMENT = (
    "ref_id string, doc_id string, legacy_id string, title string, short_title string, language string, doc_type string, ministry string, legal_area string, "
    "legal_areas array<string>, legal_sub_areas array<string>, amends array<string>, see_also array<string>, references array<string>, celex array<string>, eu_body array<string>, "
    "works array<string>, work_names map<string, string>, date_in_force string, last_change_in_force string, date_of_publication string, applies_to string, last_changed_by string, "
    "eea_references string, content string, content_unavailable boolean, paragraphs array<struct<section_id string, chapter_id string, paragraph_num string, title string, content string, position int>>, "
    f"eea_meta {EU_META}, eu_body_meta {EU_META}, ord long"
)
EU_ACT = (
    "celex string, short_title string, full_title string, form string, date_of_document string, date_of_effect string, author array<string>, subject_matter array<string>, legal_basis array<string>, "
    "in_force boolean, content string, cited array<string>, modified_by array<string>, eurovoc array<string>"
)
_STEP = 1 << 22  # so many records of a document keep their order in one number
PUBLISHER, LICENSE, DOCUMENT_URL, WORK_URL = "Lovdata", "NLOD-2.0", "https://lovdata.no/dokument/NL/", "https://lovdata.no/forarbeid/"


def _properties(**values: Column) -> Column:
    """A map of the properties that have a value; empty strings are absent but for those the reader relies on (named keep_...)."""
    pairs = [F.struct(F.lit(k.removeprefix("keep_")).alias("k"), (v.cast("string") if k.startswith("keep_") else F.nullif(v.cast("string"), F.lit(""))).alias("v")) for k, v in values.items()]
    return F.map_from_entries(F.filter(F.array(*pairs), lambda p: p["v"].isNotNull()))


def _record(rows: DataFrame, kind: Column | str, key: Column, part: int, properties: Column) -> DataFrame:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return rows.select(kind.alias("type"), key.alias("key"), F.struct(F.lit(part).alias("part"), F.col("ord")).alias("ord"), properties.alias("properties"))


def _edge(rows: DataFrame, kind: str, src: Column, dst: Column, properties: Column | None = None) -> DataFrame:
    none = F.create_map().cast("map<string, string>")
    return rows.select(F.lit(kind).alias("type"), src.alias("src_key"), dst.alias("dst_key"), F.col("ord"), (none if properties is None else properties).alias("properties"))


def _list(c: str) -> Column:
    return F.array_join(F.col(c), "; ")


def paragraph_rows(docs: DataFrame) -> DataFrame:
    """Paragraphs with text and section id: ref_id, key, label, name and their own columns, in order."""
    p = docs.select("ref_id", F.col("ord").alias("doc_ord"), F.posexplode("paragraphs").alias("n", "p")).select("ref_id", "doc_ord", "n", "p.*").where("content <> '' and section_id <> ''")
    number, title = F.coalesce("paragraph_num", F.lit("")), F.coalesce("title", F.lit(""))
    label = F.when(F.trim(number) != "", F.trim(number)).otherwise(text.section_label(F.col("section_id")))
    name = F.coalesce(text.blank_null(F.trim(F.concat(number, F.lit(" "), title))), text.blank_null(label), F.col("section_id"))
    return p.select("*", F.concat("ref_id", F.lit("#"), "section_id").alias("key"), label.alias("label"), name.alias("name"), F.struct("doc_ord", "n").alias("place"))


_AMENDMENT = ["target", "by", "date", "kind", "provision", "section", "summary", "source", "ord"]


def _in_corpus(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.join(docs.select(F.col("ref_id").alias("target")).distinct(), "target", "left_semi").select(*_AMENDMENT)


def _noted(p: DataFrame) -> DataFrame:
    """Amendments noted in texts p (ref_id, content, provision, section, o) that name an act or a date."""
    noted = p.withColumn("x", prep.note(F.col("content"))).where("x is not null").select("ref_id", "x.act", "x.date", "x.kind", "provision", "section", prep.note_text(F.col("content")), F.lit("body_note"), "o")
    return noted.toDF(*_AMENDMENT).where("not (by = '' and date = '')")


def _sections(docs: DataFrame) -> DataFrame:
    return paragraph_rows(docs).select("ref_id", "content", F.col("label").alias("provision"), F.col("section_id").alias("section"), (F.col("doc_ord") * _STEP + _STEP // 2 + 1 + F.col("n")).alias("o"))


def amendments(docs: DataFrame) -> DataFrame:
    """target, by, date, kind, provision, section, summary, source of every amendment kept: named by metadata, or noted in text.

    The act amended must be in the corpus, and a note must name an act or a date.
    """
    empty = F.lit("")
    changed = docs.where("last_changed_by <> ''").select(F.col("ref_id"), F.col("last_changed_by"), F.coalesce(dates.canonical(F.col("last_change_in_force")), empty), F.lit("unknown"), empty, empty, empty, F.lit("metadata"), F.col("ord") * _STEP)
    amends = docs.select("ref_id", "ord", F.posexplode("amends").alias("n", "to")).select("to", "ref_id", empty, F.lit("unknown"), empty, empty, empty, F.lit("metadata"), F.col("ord") * _STEP + 1 + F.col("n"))
    bodies = docs.select("ref_id", "content", empty.alias("provision"), empty.alias("section"), (F.col("ord") * _STEP + _STEP // 2).alias("o"))
    return _in_corpus(changed.toDF(*_AMENDMENT).union(amends.toDF(*_AMENDMENT)).union(_noted(bodies.union(_sections(docs)))), docs)


def versions(docs: DataFrame) -> DataFrame:
    """The amendments with a section, which are those noted in paragraphs. They are not filtered from all amendments: there a section of
    the rows of ``amends`` is a constant, and Spark's optimizer empties the input of that generator and loses its columns (an error at run time
    unless the join happens to be broadcast)."""
    return _in_corpus(_noted(_sections(docs)), docs)


def works(docs: DataFrame) -> DataFrame:
    """slug, name, kind, session, number, year of every preparatory work; the first name that a document gives counts."""
    w = docs.select("ord", "work_names", F.posexplode("works").alias("n", "slug")).select("slug", F.try_element_at("work_names", F.col("slug")).alias("name"), F.struct("ord", "n").alias("o"))
    first = w.groupBy("slug").agg(F.min_by("name", F.when(F.col("name") != "", F.col("o"))).alias("name"), F.min("o").alias("o"))
    return first.withColumn("c", prep.classify(F.col("slug"))).select("slug", F.coalesce(text.blank_null(F.col("name")), F.col("slug")).alias("name"), "c.*", "o")


def _eu_records(docs: DataFrame, acts: DataFrame, concepts: DataFrame, retrieved_at: str) -> list[DataFrame]:
    one = F.lit(0).cast("long")
    act = acts.withColumn("ord", one)
    directive = _properties(
        name=F.coalesce(text.blank_null(F.col("short_title")), F.col("celex")), celex_id=F.col("celex"), full_title=F.col("full_title"), form=F.col("form"), date_of_document=dates.canonical(F.col("date_of_document")),
        date_of_effect=dates.canonical(F.col("date_of_effect")), author=_list("author"), subject_matter=_list("subject_matter"), legal_basis=_list("legal_basis"), community=eu.community(F.col("celex")),
        url_eur_lex=eu.eli_url(F.col("celex")), in_force=F.col("in_force"), content=F.col("content"), retrieved_at=F.lit(retrieved_at),
    )
    needed = acts.select(F.explode(F.concat(F.coalesce("cited", F.array().cast("array<string>")), F.coalesce("modified_by", F.array().cast("array<string>")))).alias("celex")).union(docs.select(F.explode("eu_body")))
    stub = graph.stubs(needed.select(F.upper("celex").alias("celex")), acts, "celex").withColumn("ord", one)
    stubs = _properties(name=F.col("celex"), celex_id=F.col("celex"), community=eu.community(F.col("celex")), url_eur_lex=eu.eli_url(F.col("celex")))
    return [
        _record(act, "EUDirective", F.concat(F.lit("eu_"), "celex"), 7, directive), _record(stub, "EUDirective", F.concat(F.lit("eu_"), "celex"), 8, stubs),
        _record(concepts.withColumn("ord", one), "EuroVocConcept", F.concat(F.lit("eurovoc_"), "id"), 9, _properties(name=F.col("label"), eurovoc_id=F.col("id"), label_en=F.col("label"))),
    ]


def eu_objects(docs: DataFrame, acts: DataFrame, concepts: DataFrame, retrieved_at: str) -> DataFrame:
    """The objects of EU acts, of those that are only named, and of concepts, whose keys no other object has; nothing else is built for them."""
    return graph.dedupe_first(reduce(DataFrame.unionByName, _eu_records(docs, acts, concepts, retrieved_at)), ["key"], ["ord"])


def objects(docs: DataFrame, acts: DataFrame, concepts: DataFrame, retrieved_at: str) -> DataFrame:
    """type, key, ord, properties of every object. docs as DOCUMENT, acts as EU_ACT, concepts: id, label."""
    one = F.lit(0).cast("long")
    named = lambda rows, kind, prefix, part, **more: _record(rows.withColumn("ord", one), kind, F.concat(F.lit(prefix), "v"), part, _properties(name=F.col("v"), **more))
    ministries = docs.select(F.col("ministry").alias("v")).where("v <> ''").distinct()
    areas = docs.select(F.explode("legal_areas").alias("v")).distinct()
    subs = docs.select("ord", "legal_area", F.explode("legal_sub_areas").alias("v")).groupBy("v").agg(F.min_by("legal_area", "ord").alias("parent"))

    year, force = dates.loose_year(F.col("date_in_force")), F.col("date_in_force")
    laws = _properties(
        name=F.col("title"), title=F.col("title"), ref_id=F.col("ref_id"), doc_id=F.col("doc_id"), short_title=F.col("short_title"), legacy_id=F.col("legacy_id"), language=F.col("language"),
        date_in_force=dates.canonical(force), date_in_force_raw=dates.raw_companion(force), year_in_force=year, decade_in_force=dates.decade(year),
        last_change_in_force=dates.canonical(F.col("last_change_in_force")), date_of_publication=dates.canonical(F.col("date_of_publication")),
        date_of_publication_raw=dates.raw_companion(F.col("date_of_publication")), applies_to=F.col("applies_to"), eea_references=F.col("eea_references"), content=F.col("content"),
        content_unavailable=F.when(F.col("content_unavailable"), F.lit("true")), publisher=F.lit(PUBLISHER), license=F.lit(LICENSE), source_url=F.concat(F.lit(DOCUMENT_URL), "ref_id"), retrieved_at=F.lit(retrieved_at),
    )
    p = paragraph_rows(docs).withColumn("ord", F.col("doc_ord") * _STEP + F.col("n"))
    paragraph = _properties(
        name=F.col("name"), keep_section_label=F.col("label"), content=F.col("content"), section_id=F.col("section_id"), keep_paragraph_num=F.coalesce("paragraph_num", F.lit("")), law_ref_id=F.col("ref_id"),
        position=F.col("position"), chapter_id=F.col("chapter_id"), title=F.col("title"),
    )
    a = amendments(docs)
    label = F.when(F.col("summary") != "", F.col("summary")).when(F.col("date") != "", F.concat("by", F.lit(" ("), "date", F.lit(")"))).otherwise(F.col("by"))
    amendment = _properties(
        name=label, keep_amended_by_ref_id=F.col("by"), amendment_date=F.col("date"), amendment_type=F.col("kind"), target_provision_ref=F.col("provision"), target_law_ref_id=F.col("target"),
        change_summary=F.col("summary"), source=F.col("source"),
    )
    v = versions(docs)
    version = _properties(name=F.concat("provision", F.lit(" – "), "target"), paragraph_ref=F.concat("target", F.lit("#"), "section"), paragraph_section_id=F.col("section"), valid_from=F.col("date"), status=F.lit("current"), parent_law_ref_id=F.col("target"))
    w = works(docs).withColumn("ord", one)
    work = _properties(name=F.col("name"), ref_id=F.col("slug"), prep_type=F.col("type"), session=F.col("session"), document_number=F.col("number"), year=F.col("year"), source=F.lit("lovdata-ref"), source_url=F.concat(F.lit(WORK_URL), "slug"), content_available=F.lit(False))
    parts = [
        named(ministries, "Ministry", "ministry_", 0), named(areas, "LegalArea", "area_", 1), named(subs, "LegalArea", "subarea_", 2, parent_area=F.col("parent")),
        _record(docs, F.initcap("doc_type"), F.col("ref_id"), 3, laws), _record(p, "LegalParagraph", F.col("key"), 4, paragraph),
        _record(a, "Amendment", graph.amendment_key(F.col("target"), F.col("by"), F.col("provision"), F.col("source")), 5, amendment),
        _record(v, "ProvisionVersion", F.concat(F.lit("ver_"), text.key_part(F.col("target")), F.lit("_"), text.key_part(F.col("section"))), 6, version),
        *_eu_records(docs, acts, concepts, retrieved_at),
        _record(w, "PreparatoryWork", F.concat(F.lit("forarbeid/"), "slug"), 10, work),
    ]
    return graph.dedupe_first(reduce(DataFrame.unionByName, parts), ["key"], ["ord"])


def relationships(docs: DataFrame, acts: DataFrame, keys: DataFrame) -> DataFrame:
    """type, src_key, dst_key, properties of every relationship; see-also and references need a target among keys (key)."""
    ref, exploded = F.col("ref_id"), lambda c: docs.select("ref_id", "ord", "eea_meta", "eu_body_meta", F.explode(c).alias("v"))
    known = keys.select(F.col("key").alias("v")).distinct()
    prefixed = lambda p: F.concat(F.lit(p), "v")

    def cited(meta: str, kind: Column, **more: Column) -> Column:
        m = F.try_element_at(meta, F.upper("v"))
        return _properties(**more, reference_type=kind, eu_articles=F.array_join(m["articles"], ","), reference_context=m["context"], trigger_keyword=m["keyword"])

    header, body = (F.coalesce(F.try_element_at(c, F.upper("v"))["keyword"], F.lit("")) for c in ("eea_meta", "eu_body_meta"))
    implements = F.when(header == "", "implements").otherwise(eu.reference_type(header)["type"])
    cites = F.when(body == "", "cites_article").otherwise(eu.reference_type(body)["type"])
    have = acts.select(F.col("celex").alias("v")).distinct()
    p = paragraph_rows(docs).withColumn("ord", F.col("doc_ord"))
    a = amendments(docs)
    same = docs.where("doc_id <> ''").select("doc_id", "ref_id", "language", "ord")
    pairs = same.join(same.toDF("doc_id", "ref2", "language2", "ord2"), "doc_id").where("ord < ord2")
    chain = lambda kind, c, prefix: _edge(acts.withColumn("ord", F.lit(0).cast("long")).select("celex", "ord", F.explode(c).alias("v")), kind, F.concat(F.lit("eu_"), "celex"), prefixed(prefix))
    parts = [
        _edge(docs.where("ministry <> ''"), "ADMINISTERED_BY", ref, F.concat(F.lit("ministry_"), "ministry")), _edge(exploded("legal_areas"), "IN_LEGAL_AREA", ref, prefixed("area_")),
        _edge(exploded("legal_sub_areas"), "IN_LEGAL_AREA", ref, prefixed("subarea_"), _properties(level=F.lit("sub"))), _edge(exploded("amends"), "AMENDS", ref, F.col("v")),
        _edge(exploded("see_also").join(known, "v", "left_semi"), "SEE_ALSO", ref, F.col("v")), _edge(exploded("references").join(known, "v", "left_semi"), "REFERENCES", ref, F.col("v")),
        _edge(exploded("celex").withColumn("v", F.upper("v")).join(have, "v", "left_semi"), "IMPLEMENTS_EEA", ref, prefixed("eu_"), cited("eea_meta", implements, source=F.lit("eea_references"), is_primary=implements.isin(eu.PRIMARY), implementation_status=F.lit("unknown"))),
        _edge(exploded("works"), "PREPARES", prefixed("forarbeid/"), ref), _edge(p, "HAS_PARAGRAPH", ref, F.col("key"), _properties(position=F.col("position"))),
        _edge(exploded("eu_body"), "CITES_EU_LAW", ref, prefixed("eu_"), cited("eu_body_meta", cites)),
        _edge(docs.where("last_changed_by <> ''"), "AMENDED_BY", ref, F.col("last_changed_by"), _properties(effective_date=F.col("last_change_in_force"))),
        _edge(a, "HAS_AMENDMENT", F.col("target"), graph.amendment_key(F.col("target"), F.col("by"), F.col("provision"), F.col("source"))),
        _edge(versions(docs), "HAS_VERSION", F.col("target"), F.concat(F.lit("ver_"), text.key_part(F.col("target")), F.lit("_"), text.key_part(F.col("section")))),
        _edge(pairs, "HAS_LANGUAGE_VARIANT", ref, F.col("ref2"), _properties(source_language=F.col("language"), target_language=F.col("language2"))),
        chain("EU_CITES", "cited", "eu_"), chain("EU_MODIFIED_BY", "modified_by", "eu_"), chain("HAS_EUROVOC_DESCRIPTOR", "eurovoc", "eurovoc_"),
    ]
    rows = reduce(DataFrame.unionByName, parts)
    keyed = rows.groupBy("type", "src_key", "dst_key").agg(F.min("ord").alias("ord"))
    entries = rows.select("type", "src_key", "dst_key", "ord", F.explode("properties").alias("prop", "value"))
    merged = graph.as_map(graph.merge_properties(entries, ["type", "src_key", "dst_key"], "prop", "value", ["ord"]), ["type", "src_key", "dst_key"], "prop", "value")
    return keyed.join(merged, ["type", "src_key", "dst_key"], "left")


def derived_from(works: DataFrame) -> DataFrame:
    """src, dst of works with text that name a source among the works, other than themselves. works: slug, available, sources."""
    rows = works.where("available").select(F.col("slug").alias("src"), F.explode("sources").alias("dst"))
    return rows.join(works.select(F.col("slug").alias("dst")).distinct(), "dst", "left_semi").where("src <> dst").select("src", "dst")


def manifest(docs: DataFrame, objects: DataFrame, edges: DataFrame, coverage: DataFrame) -> DataFrame:
    """One row: documents by reference id with type and digest, counts by type, coverage, unavailable documents in order."""
    hashed = docs.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("ref_id", F.struct(F.col("doc_type").alias("type"), F.sha2("content", 256).alias("sha256")))))).alias("documents"),
        F.array_sort(F.collect_list(F.when(F.col("content_unavailable"), F.col("ref_id")))).alias("unavailable"),
    )
    count = lambda rows, name: graph.type_counts(rows).agg(F.sum("n").alias(name), F.map_from_entries(F.array_sort(F.collect_list(F.struct("type", "n")))).alias(f"{name}_by_type"))
    from .coverage import summary

    return hashed.join(count(objects, "objects")).join(count(edges, "relationships")).join(summary(coverage))


def current(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Rows with a flag whether they are the last of their key."""
    return rows.withColumn("is_current", F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).desc())) == 1)
