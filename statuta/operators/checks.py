"""Integrity checks V1 to V8. Each gives rows check, key, detail; all but aggregates of them is left to the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuta.functions import dates, refs


def _rows(df: DataFrame, check: str, key, detail) -> DataFrame:
    return df.select(F.lit(check).alias("check"), key.alias("key"), detail.alias("detail"))


def v1_duplicate_keys(objects: DataFrame) -> DataFrame:
    many = objects.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    return _rows(many, "V1", F.col("key"), F.concat(F.lit("occurs "), F.col("n").cast("string"), F.lit(" times")))


def v2_dangling(edges: DataFrame, objects: DataFrame) -> DataFrame:
    """One row for each end of an edge that is no object."""
    ends = edges.select("type", F.explode(F.array(*(F.struct(F.col(c).alias("end"), F.lit(f" {side}").alias("side")) for c, side in (("src_key", "source"), ("dst_key", "target"))))).alias("e"))
    missing = ends.select("type", "e.*").join(objects.select(F.col("key").alias("__k")), F.col("end") == F.col("__k"), "left_anti")
    return _rows(missing, "V2", F.col("end"), F.concat("type", "side"))


def v3_self_loops(edges: DataFrame) -> DataFrame:
    return _rows(edges.where("src_key = dst_key"), "V3", F.col("src_key"), F.col("type"))


def v4_structure(paragraphs: DataFrame, acts: DataFrame) -> DataFrame:
    """The first rule that a paragraph breaks: ids present, key made of them, parent there."""
    known = acts.select(F.col("key").alias("__act")).distinct()
    joined = paragraphs.join(known, F.col("law_ref_id") == F.col("__act"), "left")
    detail = (
        F.when(F.coalesce("law_ref_id", F.lit("")) == "", "empty law_ref_id").when(F.coalesce("section_id", F.lit("")) == "", "empty section_id")
        .when(F.col("key") != F.concat("law_ref_id", F.lit("#"), "section_id"), "key mismatch").when(F.col("__act").isNull(), "missing parent")
    )
    return _rows(joined.withColumn("__d", detail).where("__d is not null"), "V4", F.col("key"), F.col("__d"))


def v5_has_paragraph(edges: DataFrame, paragraphs: DataFrame) -> DataFrame:
    """Edges to what is no paragraph or to another act's, and paragraphs without an edge."""
    has = edges.where("type = 'HAS_PARAGRAPH'")
    p = paragraphs.groupBy(F.col("key").alias("__p")).agg(F.min("law_ref_id").alias("__law"))
    joined = has.join(p, F.col("dst_key") == F.col("__p"), "left")
    wrong = F.when(F.col("__p").isNull(), "target is no paragraph").when(F.col("src_key") != F.col("__law"), "source is not the parent")
    orphans = paragraphs.join(has.select(F.col("dst_key").alias("__t")).distinct(), F.col("key") == F.col("__t"), "left_anti")
    return _rows(joined.withColumn("__d", wrong).where("__d is not null"), "V5", F.col("dst_key"), F.col("__d")).union(_rows(orphans, "V5", F.col("key"), F.lit("orphan paragraph")))


def v6_ref_ids(acts: DataFrame) -> DataFrame:
    return _rows(acts.where(~F.coalesce(F.col("ref_id").rlike(refs.REF_ID), F.lit(False))), "V6", F.col("key"), F.coalesce("ref_id", F.lit("")))


def v7_dates(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Date properties that are malformed, no calendar day or too late; blank ones are absent."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in columns))).alias("p")
    found = rows.select("key", pairs).where(F.trim("p.value") != "").withColumn("__d", dates.defect(F.col("p.value"))).where("__d is not null")
    return _rows(found, "V7", F.col("key"), F.concat("p.name", F.lit(" "), "__d"))


def v8_counts(actual: DataFrame, manifest: DataFrame) -> DataFrame:
    """type, n against type, expected, both ways."""
    a, m = actual.select(F.col("type").alias("__t"), "n"), manifest.select("type", "expected")
    joined = m.join(a, F.col("type") == F.col("__t"), "full_outer")
    name, n, e = F.coalesce("type", "__t"), F.coalesce("n", F.lit(0)), F.col("expected")
    detail = F.when(e.isNull(), F.concat(F.lit("not in manifest, actual "), n.cast("string"))).when(e != n, F.concat(F.lit("manifest "), e.cast("string"), F.lit(", actual "), n.cast("string")))
    return _rows(joined.withColumns({"__n": name, "__d": detail}).where("__d is not null"), "V8", F.col("__n"), F.col("__d"))


def declared_not_emitted(declared: DataFrame, emitted: DataFrame, name: str) -> DataFrame:
    return declared.select(name).distinct().join(emitted.select(name).distinct(), name, "left_anti")
