"""Queries on snapshots and reconciliation, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.functions import dates
from statuta.operators import recon
from statuta.sources import corpus
from statuta.sources.corpus import read


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("ref_id"), "doc_id", "text")
    old = d.where("doc_id % 10 <> 1").select("ref_id", F.sha2("text", 256).alias("sha256"))
    new = d.where("doc_id % 10 <> 2").select("ref_id", F.sha2(F.when(F.col("doc_id") % 10 == 3, F.concat("text", F.lit("!"))).otherwise(F.col("text")), 256).alias("sha256"))
    return old, new


def manifest_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that two snapshots add, remove, change or leave."""
    return recon.manifest_diff(*_snapshots(spark, sf_dir))


def manifest_diff_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_diff(spark, sf_dir).groupBy("status").agg(F.count("*").alias("n"), F.min("ref_id").alias("first_ref"))


def gap_fill_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = corpus.acts(spark, sf_dir)
    return recon.missing_objects(a.select("key", "area"), a.where("ord % 4 <> 0").select("key"))


def gap_fill_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges between acts that the store has, which it lacks."""
    edges = corpus.relationships(spark, sf_dir)
    live = corpus.acts(spark, sf_dir).where("ord % 5 <> 0").select("key", F.md5("key").alias("id"))
    stored = edges.where("length(src_key) % 2 = 0").select("type", F.md5("src_key").alias("src_id"), F.md5("dst_key").alias("dst_id"))
    return recon.missing_edges(edges, live, stored)


def _customers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    c = read(spark, sf_dir, "customer")
    seed = c.select(F.col("c_custkey").cast("string").alias("key"), F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 9 != 0, F.col("c_mktsegment")).alias("segment"), F.lit("2024-07-08").alias("since"))
    clock = F.when(F.col("c_custkey") % 2 == 0, F.lit("2024-07-08T00:00:00Z")).otherwise(F.lit("2024-07-08"))
    live = c.where("c_custkey % 6 <> 0").select(F.col("c_custkey").cast("string").alias("key"), F.when(F.col("c_custkey") % 7 == 0, F.lower("c_name")).otherwise(F.col("c_name")).alias("name"), F.col("c_mktsegment").alias("segment"), clock.alias("since"))
    return seed, live


def property_sync_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties to set or delete so that the store equals the seed."""
    return recon.property_delta(*_customers(spark, sf_dir), ["name", "segment", "since"])


def date_retype_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored dates that lack clock time and zone."""
    return recon.retype_candidates(*_customers(spark, sf_dir), "since")


def normalize_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates in eight forms, canonical or kept raw."""
    from .integrity import _date_strings

    d = F.col("date_in_force")
    return _date_strings(spark, sf_dir).select("key", dates.canonical(d).alias("date_in_force"), dates.raw_companion(d).alias("date_in_force_raw"))


def loose_year_decade(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .integrity import _date_strings

    return _date_strings(spark, sf_dir).withColumn("decade", dates.decade(dates.loose_year(F.col("date_in_force")))).groupBy("decade").agg(F.count("*").alias("n"))


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last fetch of each user's event type, as a manifest of entries keyed by both."""
    e = read(spark, sf_dir, "events")
    return e.groupBy("user_id", "event_type").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"))


QUERIES = {f.__name__: f for f in (manifest_diff, manifest_diff_counts, gap_fill_objects, gap_fill_edges, property_sync_delta, date_retype_candidates, normalize_dates, loose_year_decade, upsert_latest)}

_DIFF = """o as (select doc_id::varchar as ref_id, text from documents where doc_id % 10 <> 1),
  n as (select doc_id::varchar as ref_id, case when doc_id % 10 = 3 then text || '!' else text end as text from documents where doc_id % 10 <> 2),
  diff as (select coalesce(o.ref_id, n.ref_id) as ref_id, case when o.ref_id is null then 'added' when n.ref_id is null then 'removed' when o.text <> n.text then 'changed' else 'unchanged' end as status
    from o full join n on o.ref_id = n.ref_id)"""
_CUST = """seed as (select c_custkey::varchar as key, c_custkey as k, c_name as name, case when c_custkey % 9 <> 0 then c_mktsegment end as segment, '2024-07-08' as since from customer),
  live as (select c_custkey::varchar as key, case when c_custkey % 7 = 0 then lower(c_name) else c_name end as name, c_mktsegment as segment,
    case when c_custkey % 2 = 0 then '2024-07-08T00:00:00Z' else '2024-07-08' end as since from customer where c_custkey % 6 <> 0)"""


def _forms() -> str:
    from .integrity import _DATES

    return _DATES


ORACLE_SQL = {
    "manifest_diff": f"with {_DIFF} select ref_id, status from diff",
    "manifest_diff_counts": f"with {_DIFF} select status, count(*) as n, min(ref_id) as first_ref from diff group by 1",
    "gap_fill_objects": f"with {corpus.SQL} select key, area from acts where ord % 4 = 0",
    "gap_fill_edges": f"""with {corpus.SQL}, live as (select key from acts where ord % 5 <> 0)
      select type, src_key, dst_key from relationships where src_key <> dst_key and length(src_key) % 2 <> 0 and src_key in (select key from live) and dst_key in (select key from live)""",
    "property_sync_delta": f"""with {_CUST}
      select s.key, 'name' as prop, 'set' as action, s.name as value from seed s join live l on s.key = l.key where s.name <> l.name
      union all select s.key, 'segment', 'delete', null from seed s join live l on s.key = l.key where s.segment is null and l.segment is not null""",
    "date_retype_candidates": f"with {_CUST} select s.key, s.since as seed_value, l.since as live_value from seed s join live l on s.key = l.key where not contains(l.since, 'T')",
    "normalize_dates": f"""with {_forms()} select key, case when k in (0, 1, 2, 3, 4) then d end as date_in_force, case when k in (5, 6, 7) then raw end as date_in_force_raw
      from (select o_orderkey::varchar as key, o_orderkey % 8 as k, strftime(o_orderdate, '%Y-%m-%d') as d from orders) join (select key, d as raw from forms) using (key)""",
    "loose_year_decade": """select case when o_orderkey % 8 = 5 then '2050s' when o_orderkey % 8 in (0, 1, 2, 3, 4, 6, 7) then (year(o_orderdate) // 10 * 10)::varchar || 's' end as decade, count(*) as n from orders group by 1""",
    "upsert_latest": "select user_id, event_type, event_id from events qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1",
}
