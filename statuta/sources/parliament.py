"""Publications of the parliament: their XML as Markdown, the documents they rest on, preparatory works with their full text."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuta.functions import prep

from .files import match_publications
from .pages import Node, parse

# Tags by how they are written; others are gone through.
HEADINGS = set("tit tittel stikktittel navn doktit".split())
BLOCKS = set("a uttal endring forsl tilstortinget innst aar".split())
QUOTES = set("sitat blksit komtilr".split())
SOURCE, URL = "kildedok", "https://lovdata.no/forarbeid/"
PUBLICATION = "https://data.stortinget.no/eksport/publikasjon?publikasjonid="


def _text(node: Node) -> str:
    todo, out = [node], []
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            todo.extend(reversed(x.children))
    return "".join(out).strip()


def table(node: Node) -> str:
    rows = []
    for n in node.walk():
        if n.tag == "row" and (cells := [_text(c) for c in n.children if isinstance(c, Node) and c.tag == "entry"]):
            rows.append("| " + " | ".join(cells) + " |")
    return "\n".join(rows)


def markdown(xml: str) -> str:
    """Headings, quotes, blocks and tables of a publication; loose text stays as it is."""
    out: list[str] = []
    todo: list = [parse(xml)]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
            continue
        written = _text(x) if x.tag in HEADINGS | BLOCKS | QUOTES else ""
        if x.tag == "table":
            written = table(x)
        elif x.tag in HEADINGS:
            written = written and f"### {written}"
        elif x.tag in QUOTES:
            written = written and "> " + written.replace("\n", "\n> ")
        elif x.tag not in BLOCKS:
            todo += reversed(x.children)
            continue
        out += [written, "\n\n"] if written else []
    return "".join(out).strip()


def publications(rows: DataFrame) -> DataFrame:
    """id, content, source_hash, sources (texts of the documents named as sources) of publications (id, xml)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            trees = [parse(x or "") for x in f["xml"]]
            yield pd.DataFrame({"id": f["id"], "content": [markdown(x or "") for x in f["xml"]], "sources": [[_text(n) for n in t.walk() if n.tag == SOURCE] for t in trees]})

    hashed = rows.select("id", F.sha2(F.col("xml").cast("binary"), 256).alias("source_hash"))
    return rows.select("id", "xml").mapInPandas(run, "id string, content string, sources array<string>").join(hashed, "id")


def enriched(works: DataFrame, index: DataFrame, texts: DataFrame) -> DataFrame:
    """works with the full text of the publication that each is matched with: stortinget_id, title, content, content_available, source,
    source_url, source_hash, derives_from (slugs of its sources). Works without a match or a text say so.

    works: slug, prep_type, number, candidates (ids by preference); index: id, title; texts: publications().
    """
    matched = match_publications(works.select("slug", "number", "candidates"), index).toDF("__slug", "__id")
    found = texts.where(F.trim("content") != "").select(F.col("id").alias("__tid"), "content", "source_hash", F.array_sort(F.array_distinct(F.flatten(F.transform("sources", prep.source_slugs)))).alias("derives_from"))
    titled = index.select(F.col("id").alias("__iid"), F.col("title"))
    out = works.join(matched, F.col("slug") == F.col("__slug"), "left").join(titled, F.col("__id") == F.col("__iid"), "left").join(found, F.col("__id") == F.col("__tid"), "left")
    has = F.col("__tid").isNotNull()
    return out.select(
        "slug", "prep_type", F.when(has, F.col("__id")).alias("stortinget_id"), F.when(has, F.col("title")).alias("title"), "content", has.alias("content_available"),
        F.when(has, "stortinget").otherwise("lovdata-ref").alias("source"), F.when(has, F.concat(F.lit(PUBLICATION), "__id")).otherwise(F.concat(F.lit(URL), "slug")).alias("source_url"),
        "source_hash", F.coalesce("derives_from", F.array().cast("array<string>")).alias("derives_from"), F.col("__id").isNotNull().alias("matched"),
    )


def statistics(rows: DataFrame) -> DataFrame:
    """prep_type, with_full_text, unmatched, failed of enriched(): a match without a text is a failure and not a miss."""
    return rows.groupBy("prep_type").agg(
        F.count_if("content_available").alias("with_full_text"), F.count_if(~F.col("matched")).alias("unmatched"), F.count_if(F.col("matched") & ~F.col("content_available")).alias("failed")
    )
