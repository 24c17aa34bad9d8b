"""Queries that build whole records from the derived corpus, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statuta.operators import build
from statuta.sources import corpus
from statuta.sources.corpus import read


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document for each order in the builder's schema; its lines are the paragraphs, an order's own lines at most."""
    a = corpus.acts(spark, sf_dir)
    p = corpus.paragraphs(spark, sf_dir).groupBy(F.col("law_ref_id").alias("key")).agg(
        F.array_sort(F.collect_list(F.struct("section_id", F.lit("").alias("chapter_id"), "paragraph_num", F.lit("").alias("title"), "content", F.col("position").cast("int").alias("position")))).alias("paragraphs")
    )
    nations = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer"), F.col("c_nationkey").cast("string").alias("ministry"))
    before = F.lag("key").over(Window.partitionBy("customer").orderBy("ord"))
    d = a.withColumn("last_changed_by", before).join(p, "key", "left").join(nations, "customer", "left")
    schema = T._parse_datatype_string(build.DOCUMENT)
    own = {
        "ref_id": F.col("key"), "title": F.col("key"), "doc_type": F.lit("law"), "ministry": F.col("ministry"), "legal_area": F.substring("area", 3, 20), "legal_areas": F.array(F.substring("area", 3, 20)),
        "date_in_force": F.substring("key", 5, 10), "last_change_in_force": F.substring("last_changed_by", 5, 10), "last_changed_by": F.col("last_changed_by"), "paragraphs": F.col("paragraphs"), "ord": F.col("ord"), "content": F.lit(""),
        "celex": F.array(F.lower(_celex(F.col("ord")))), "eu_body": F.when(F.col("ord") % 10 == 0, F.array(_celex(F.col("ord") + 7))).otherwise(F.array().cast("array<string>")),
    }
    return d.select(*(own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema))


def _celex(n) -> Column:
    return F.concat(F.lit("3"), (F.lit(1995) + n % 25).cast("string"), F.lit("L"), F.lpad((n % 997 + 1).cast("string"), 4, "0"))


def _eu(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """An EU act for each part, which cites the next, is modified by another and has a concept; the concepts."""
    k = F.col("p_partkey")
    own = {"celex": _celex(k), "cited": F.array(_celex(k + 1)), "modified_by": F.array(_celex(k * 3)), "eurovoc": F.array((k % 50).cast("string")), "in_force": F.lit(True)}
    acts = read(spark, sf_dir, "part").select(*(own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in T._parse_datatype_string(build.EU_ACT)))
    concepts = spark.range(50).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("concept "), F.col("id").cast("string")).alias("label"))
    return acts, concepts


def _records(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs, (acts, concepts) = _documents(spark, sf_dir), _eu(spark, sf_dir)
    objects = build.objects(docs, acts, concepts, "2024-07-08")
    return objects, build.relationships(docs, acts, docs.select(F.col("ref_id").alias("key")))


def built_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects by type, with the properties that they have in all."""
    objects, _ = _records(spark, sf_dir)
    return objects.groupBy("type").agg(F.count("*").alias("n"), F.sum(F.size("properties")).alias("properties"))


def built_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, edges = _records(spark, sf_dir)
    return edges.groupBy("type").agg(F.count("*").alias("n"), F.count_if(F.size("properties") > 0).alias("with_properties"))


def built_eu_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EU acts, stubs of those that are only named, and concepts, one by one."""
    objects = build.eu_objects(_documents(spark, sf_dir), *_eu(spark, sf_dir), "2024-07-08")
    p = F.col("properties")
    return objects.where("key like 'eu%'").select("type", "key", p["name"].alias("name"), p["community"].alias("community"), p["in_force"].alias("in_force"))


def built_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every relationship, with the type that a reference to an EU act has."""
    _, edges = _records(spark, sf_dir)
    return edges.select("type", "src_key", "dst_key", F.col("properties")["reference_type"].alias("reference_type"))


QUERIES = {f.__name__: f for f in (built_objects, built_relationships, built_eu_objects, built_edges)}

_BASE = f"""with {corpus.SQL},
  docs as (select a.key, c.c_nationkey, area, lag(a.key) over (partition by customer order by ord) as prev from acts a left join customer c on a.customer = c.c_custkey),
  par as (select distinct key, law_ref_id from paragraphs)"""
_DUCK = "'3' || (1995 + ({0}) % 25) || 'L' || lpad((({0}) % 997 + 1)::varchar, 4, '0')"
_EU = f"""eu as (select {_DUCK.format("p_partkey")} as celex, {_DUCK.format("p_partkey + 1")} as cited, {_DUCK.format("p_partkey * 3")} as modified, p_partkey % 50 as concept from part)"""
ORACLE_SQL = {
    "built_objects": f"""{_BASE}, {_EU},
      eu_acts as (select celex from eu union select cited from eu union select modified from eu union select {_DUCK.format("o_orderkey + 7")} from orders where o_orderkey % 10 = 0)
      select 'Ministry' as type, count(distinct c_nationkey) as n, count(distinct c_nationkey) as properties from docs union all select 'LegalArea', count(distinct area), count(distinct area) from docs
      union all select 'Law', count(*), (count(*) * 10 + count(prev))::bigint from docs union all select 'LegalParagraph', count(*), count(*) * 7 from par
      union all select 'Amendment', count(prev), count(prev) * 6 from docs union all select 'EuroVocConcept', 50, 150
      union all select 'EUDirective', count(*), (count(*) * 4 + 2 * count(*) filter (celex in (select celex from eu)))::bigint from eu_acts""",
    "built_eu_objects": f"""with {_EU}
      select 'EUDirective' as type, 'eu_' || celex as key, celex as name, case when substr(celex, 2, 4) <= '2009' then 'EF' else 'EU' end as community, case when celex in (select celex from eu) then 'true' end as in_force
      from (select celex from eu union select cited from eu union select modified from eu union select {_DUCK.format("o_orderkey + 7")} from orders where o_orderkey % 10 = 0) x(celex)
      union all select 'EuroVocConcept', 'eurovoc_' || c, 'concept ' || c, null, null from range(50) r(c)""",
    "built_edges": f"""{_BASE}, {_EU}
      select 'ADMINISTERED_BY' as type, key as src_key, 'ministry_' || c_nationkey as dst_key, null as reference_type from docs where c_nationkey is not null
      union all select 'IN_LEGAL_AREA', key, 'area_' || substr(area, 3, 20), null from docs union all select 'HAS_PARAGRAPH', law_ref_id, key, null from par
      union all select 'AMENDED_BY', key, prev, null from docs where prev is not null
      union all select 'HAS_AMENDMENT', key, 'amend_' || replace(replace(key, '/', '_'), '-', '_') || '_' || replace(replace(prev, '/', '_'), '-', '_') || '__metadata', null from docs where prev is not null
      union all select 'IMPLEMENTS_EEA', a.key, 'eu_' || e.celex, 'implements' from acts a join (select distinct celex from eu) e on e.celex = {_DUCK.format("a.ord")}
      union all select 'CITES_EU_LAW', key, 'eu_' || {_DUCK.format("ord + 7")}, 'cites_article' from acts where ord % 10 = 0
      union all select distinct 'EU_CITES', 'eu_' || celex, 'eu_' || cited, null from eu union all select distinct 'EU_MODIFIED_BY', 'eu_' || celex, 'eu_' || modified, null from eu
      union all select distinct 'HAS_EUROVOC_DESCRIPTOR', 'eu_' || celex, 'eurovoc_' || concept, null from eu""",
    "built_relationships": f"""{_BASE}, {_EU}, edges as (
      select 'ADMINISTERED_BY' as type, count(c_nationkey) as n, 0::bigint as with_properties from docs union all select 'IN_LEGAL_AREA', count(*), 0 from docs union all select 'HAS_PARAGRAPH', count(*), count(*) from par
      union all select 'AMENDED_BY', count(prev), count(prev) from docs union all select 'HAS_AMENDMENT', count(prev), 0 from docs
      union all select 'IMPLEMENTS_EEA', count(*), count(*) from acts where {_DUCK.format("ord")} in (select celex from eu) union all select 'CITES_EU_LAW', count(*), count(*) from acts where ord % 10 = 0
      union all select 'EU_CITES', count(distinct (celex, cited)), 0 from eu union all select 'EU_MODIFIED_BY', count(distinct (celex, modified)), 0 from eu union all select 'HAS_EUROVOC_DESCRIPTOR', count(distinct (celex, concept)), 0 from eu)
      select * from edges""",
}
