"""Marked-up acts to documents in the builder's schema: Python reads the tree, columns read the prose."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuta.functions import dates, eu, text
from statuta.operators.build import DOCUMENT

from . import acts, pages

# Fixed value: how keys of acts, regulations and resolutions begin.
REF = re.compile(r"^(?:lov|forskrift|res)/\d{4}-\d{2}-\d{2}")
# Terms of the head list and the columns that they fill.
TERMS = {
    "refid": "ref_id", "dokid": "doc_id", "legacyID": "legacy_id", "title": "title", "titleShort": "short_title", "dateInForce": "date_in_force", "lastChangeInForce": "last_change_in_force",
    "dateOfPublication": "date_of_publication", "appliesTo": "applies_to", "eeaReferences": "eea_references",
}
_TEXTS = [*dict.fromkeys(TERMS.values()), "language", "ministry", "legal_area", "last_changed_by", "content", "source_text"]
_LISTS = ["legal_areas", "legal_sub_areas", "amends", "see_also", "references", "works", "work_texts"]
PARAGRAPHS = "array<struct<section_id string, chapter_id string, paragraph_num string, title string, content string, position int>>"
RAW = "doc_type string, ord long, " + ", ".join(f"{c} string" for c in _TEXTS) + ", " + ", ".join(f"{c} array<string>" for c in _LISTS) + f", unavailable boolean, paragraphs {PARAGRAPHS}, eu_links array<struct<code string, left string, ref string, right string>>"


def _target(href: str) -> str:
    return href.strip().removeprefix("/").split("#")[0]


def _read(html: str) -> dict | None:
    """The fields of one document; none without a reference id."""
    root = pages.parse(html)
    out: dict = {c: "" for c in _TEXTS} | {c: [] for c in _LISTS}
    for dl in (n for n in root.walk() if n.tag == "dl"):
        term = ""
        for c in (c for c in dl.children if isinstance(c, pages.Node)):
            if c.tag == "dt":
                term = next(iter(c.attributes.get("class", "").split()), "")
            elif c.tag == "dd":
                anchors = [n for n in c.walk() if n.tag == "a"]
                refs = [r for a in anchors if REF.match(r := _target(a.attributes.get("href", "")))]
                if term in TERMS:
                    out[TERMS[term]] = c.text().removeprefix("Gjelder for").strip() if term == "appliesTo" else c.text()
                elif term == "ministry":
                    out["ministry"] = out["ministry"] or next((t for n in c.walk() if n.tag == "li" and (t := n.text())), "")
                elif term == "legalArea":
                    for a in anchors:
                        kind = "legal_sub_areas" if "." in a.attributes.get("href", "") else "legal_areas"
                        if a.text() and a.text() not in out[kind]:
                            out[kind].append(a.text())
                elif term == "lastChangedBy" and anchors:
                    out["last_changed_by"] = anchors[0].attributes.get("href", "").strip().removeprefix("/").split(" fra ")[0]
                elif term in ("changesToDocuments", "miscInformation"):
                    kind = "amends" if term == "changesToDocuments" else "see_also"
                    out[kind] += [r for r in dict.fromkeys(refs) if r not in out[kind]]
    if not out["ref_id"]:
        return None
    out["legal_area"] = next(iter(out["legal_areas"]), "")
    out["language"] = next((n.attributes["lang"] for n in root.walk() if n.attributes.get("lang")), "")
    for a in (n for n in root.walk() if n.tag == "a"):
        slug = re.match(r"^/?forarbeid/([^/#]+)", a.attributes.get("href", "").strip())
        if slug and slug[1] not in out["works"]:
            out["works"].append(slug[1])
            out["work_texts"].append(a.text())
    main = next((n for n in root.walk() if n.tag == "main" and n.attributes.get("id") == "dokument"), None)
    out["unavailable"] = acts.is_unavailable(root)
    out["paragraphs"], out["eu_links"] = [], []
    if main:
        found = {_target(n.attributes.get("href", "")) for n in main.walk() if n.tag == "a"}
        out["references"] = sorted(r for r in found if REF.match(r) and r != out["ref_id"])
        out["content"], out["paragraphs"] = acts.body(main)
        out["source_text"], out["eu_links"] = main.text(), acts.eu_links(main)
    return out


def documents(rows: DataFrame) -> DataFrame:
    """Documents as DOCUMENT, and source_text for coverage, of rows (doc_type, ord, html); those without a reference id are left out."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = [{"doc_type": r.doc_type, "ord": r.ord} | d for r in f.itertuples(index=False) if (d := _read(r.html or ""))]
            yield pd.DataFrame(out, columns=["doc_type", "ord", *_TEXTS, *_LISTS, "unavailable", "paragraphs", "eu_links"])

    raw = rows.select("doc_type", F.col("ord").cast("long"), "html").mapInPandas(run, RAW)
    header = F.coalesce("eea_references", F.lit(""))

    def meta(link: Column) -> Column:
        clause = eu.clause_between(link["left"], link["ref"], link["right"])
        found = F.struct(clause.alias("context"), eu.reference_type(clause)["keyword"].alias("keyword"), eu.articles(clause).alias("articles"))
        return F.struct(link["code"], F.when(link["ref"] != "", found).otherwise(F.struct(F.lit("").alias("context"), F.lit("").alias("keyword"), F.array().cast("array<string>").alias("articles"))))

    made = raw.withColumns({
        "celex": F.array_sort(eu.celex_ids(header)), "eea_meta": eu.reference_meta(header), "eu_body": F.transform("eu_links", lambda x: x["code"]), "eu_body_meta": F.map_from_entries(F.transform("eu_links", meta)),
        "work_names": F.map_from_arrays("works", "work_texts"), "content_unavailable": F.col("unavailable"),
    })
    return made.select(*(c.split()[0] for c in _columns(DOCUMENT)), "source_text")


def _columns(schema: str) -> list[str]:
    from pyspark.sql import types as T

    return [f.name for f in T._parse_datatype_string(schema)]


def model_text(docs: DataFrame) -> DataFrame:
    """ref_id, text: what the parsed document holds, its body and titles, for coverage against source_text."""
    titles = F.transform(F.coalesce("paragraphs", F.array().cast(PARAGRAPHS)), lambda p: text.blank_null(p["title"]))
    return docs.select("ref_id", F.concat_ws("\n\n", text.blank_null(F.col("content")), F.array_join(titles, "\n\n")).alias("text"))


def normalised(counts: DataFrame, columns: list[str]) -> DataFrame:
    """How many values of each date column are dates, and how many are kept raw."""
    return counts.agg(*(F.count(dates.canonical(F.col(c))).alias(f"{c}_dates") for c in columns), *(F.count(dates.raw_companion(F.col(c))).alias(f"{c}_raw") for c in columns))
