"""Exam documents to evaluation items: areas of courses, problems of documents, items from paper and guide, statistics of a build."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statuta.functions import text

from . import evals

# Courses and their legal areas.
AREAS = {
    "JUS1111": "privatrett", "JUS1211": "privatrett", "JUS2111": "statsforfatningsrett", "JUS2211": "forvaltningsrett", "JUS3111": "formuerett", "JUS3112": "formuerett",
    "JUS3211": "strafferett", "JUS3212": "strafferett", "JUS3213": "formuerett", "JUS3220": "rettshistorie", "JUS4111": "metode", "JUS4121": "rettsteori", "JUS4122": "rettsteori",
    "JUS4123": "rettsteori", "JUS4211": "strafferett", "JUS4213": "strafferett", "JUR1000": "privatrett", "JUR2000": "privatrett", "JUR3000": "privatrett", "JUR4000": "privatrett",
}
# What an item holds before anything is known of it.
DEFAULTS = {"legal_area": "", "difficulty": "", "needs_curation": True, "answerable": False}


def legal_area(course: Column) -> Column:
    """The area of a course; empty for one that isn't in the table."""
    known = F.create_map(*(F.lit(x) for pair in AREAS.items() for x in pair))
    return F.coalesce(F.element_at(known, F.coalesce(course, F.lit(""))), F.lit(""))


def problem(course: Column, semester: Column, kind: Column) -> Column:
    """What a fetched document lacks first; empty if nothing."""
    lacks = lambda c: F.coalesce(c, F.lit("")) == ""
    return F.when(lacks(course), "missing course").when(lacks(semester), "missing semester").when(lacks(kind), "missing kind").otherwise("")


def items(papers: DataFrame, guides: DataFrame, abbreviations: DataFrame, acts: DataFrame, index: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """Items, and the references that did not resolve (item, act, token, reason).

    papers, guides: id, course, semester, language, url, source_url, text. A course and semester give one item, from its paper and the
    guide that goes with it; gold points and references come from the guide's text. Without a guide an item is not answerable.
    """
    group = ["course", "semester"]
    paired = evals.pair(papers.select("id", *group, "language"), guides.select("id", *group, "language"), group)
    named = lambda x, p: x.select(F.col("id").alias(p), *(F.col(c).alias(f"{p}_{c}") for c in ("url", "source_url", "text")))
    both = paired.join(named(papers, "paper"), "paper").join(named(guides, "guide"), "guide", "left")
    key = F.concat_ws("-", F.lit(source), F.lower("course"), "semester")
    points = F.coalesce(text.points(F.col("guide_text")), F.array().cast("array<string>"))
    base = both.select(
        key.alias("id"), "course", "semester", F.col("paper_language").alias("language"), legal_area(F.col("course")).alias("legal_area"), F.lit(DEFAULTS["difficulty"]).alias("difficulty"),
        F.btrim(F.coalesce("paper_text", F.lit("")), F.lit(" \t\r\n")).alias("question"), points.alias("gold_points"), F.col("paper_source_url").alias("source_url"),
        F.col("paper_url").alias("oppgave_url"), F.col("guide_url").alias("veiledning_url"), F.lit(DEFAULTS["needs_curation"]).alias("needs_curation"), F.coalesce("guide_text", F.lit("")).alias("__guide"),
    )
    found = evals.exam_refs(base.select(F.col("id").alias("doc_id"), F.col("__guide").alias("content")), abbreviations).select("doc_id", "act", "token").distinct()
    judged = evals.resolve_candidates(found, acts, index).select(F.col("act").alias("__a"), F.col("token").alias("__t"), "reason", "ref")
    judged = found.join(judged, (F.col("act") == F.col("__a")) & (F.col("token") == F.col("__t"))).drop("__a", "__t")
    refs = judged.where("reason is null").groupBy(F.col("doc_id").alias("__item")).agg(F.array_sort(F.collect_set("ref")).alias("gold_refs"))
    out = base.drop("__guide").join(refs, F.col("id") == F.col("__item"), "left").drop("__item").withColumn("gold_refs", F.coalesce("gold_refs", F.array().cast("array<string>")))
    out = out.withColumn("answerable", (F.size("gold_points") > 0) | (F.size("gold_refs") > 0))
    return out, judged.where("reason is not null").select(F.col("doc_id").alias("item"), "act", "token", "reason")


def statistics(items: DataFrame, unresolved: DataFrame) -> DataFrame:
    """One row: papers, guides, items, with and without points or guide, references resolved and not."""
    guide = F.col("veiledning_url").isNotNull()
    left = unresolved.agg(F.count("*").alias("unresolved_refs"))
    return items.agg(
        F.count("*").alias("exam_papers"), F.count_if(guide).alias("veiledninger"), F.count("*").alias("items"), F.count_if(F.size("gold_points") > 0).alias("with_gold_points"),
        F.count_if(~guide).alias("no_veiledning"), F.coalesce(F.sum(F.size("gold_refs")), F.lit(0)).alias("resolved_refs"),
    ).join(F.broadcast(left))


def case_items(rows: DataFrame, key: str, number: str, prefix: str) -> DataFrame:
    """Items of court cases: rows key, number, question, pos, sentence, score, summary; the holding is the gold point."""
    best = evals.gold_holding(rows, key)
    first = rows.groupBy(key).agg(F.min(number).alias("__n"), F.min_by("question", "pos").alias("question"))
    made = first.join(best, key)
    points = F.when(F.trim("holding") != "", F.array(F.trim("holding"))).otherwise(F.array().cast("array<string>"))
    return made.select(F.concat(F.lit(f"{prefix}-"), F.lpad(F.col("__n").cast("string"), 5, "0")).alias("id"), "question", points.alias("gold_points"), (F.size(points) > 0).alias("answerable"), F.lit(DEFAULTS["needs_curation"]).alias("needs_curation"))
