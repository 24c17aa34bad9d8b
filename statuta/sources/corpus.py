"""A legal corpus derived from order tables: acts, paragraphs and relationships, as DataFrames and as SQL for checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def acts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key, ord, area, status, customer: one act for each order."""
    o = read(spark, sf_dir, "orders")
    key = F.concat(F.lit("lov/"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("-"), F.col("o_orderkey").cast("string"))
    return o.select(key.alias("key"), F.col("o_orderkey").alias("ord"), F.col("o_orderpriority").alias("area"), F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("customer"))


def paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key, law_ref_id, section_id, paragraph_num, position, content, ord, ord2: one row for each order line; keys repeat."""
    n = F.col("l_linenumber").cast("string")
    lines = read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ord_act"), F.concat(F.lit("paragraf-"), n).alias("section_id"), F.concat(F.lit("§ "), n).alias("paragraph_num"),
        F.col("l_linenumber").alias("position"), F.concat(F.lit("Se § "), (F.col("l_partkey") % 7 + 1).cast("string"), F.lit(" og §§ 8, 9.")).alias("content"),
        F.col("l_partkey").alias("ord"), F.col("l_suppkey").alias("ord2"),
    )
    own = acts(spark, sf_dir).select(F.col("ord").alias("ord_act"), F.col("key").alias("law_ref_id"))
    return lines.join(own, "ord_act").withColumn("key", F.concat("law_ref_id", F.lit("#"), "section_id")).drop("ord_act")


def relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """type, src_key, dst_key, position: paragraphs, ministries, areas, and the customer's act before."""
    a = acts(spark, sf_dir)
    p = paragraphs(spark, sf_dir)
    nations = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer"), "c_nationkey")
    has = p.select(F.lit("HAS_PARAGRAPH").alias("type"), F.col("law_ref_id").alias("src_key"), F.col("key").alias("dst_key"), F.col("position").cast("long").alias("position"))
    none = F.lit(None).cast("long").alias("position")
    ministry = a.join(nations, "customer").select(F.lit("ADMINISTERED_BY").alias("type"), F.col("key").alias("src_key"), F.concat(F.lit("ministry_"), F.col("c_nationkey").cast("string")).alias("dst_key"), none)
    area = a.select(F.lit("IN_LEGAL_AREA").alias("type"), F.col("key").alias("src_key"), F.concat(F.lit("area_"), F.substring("area", 1, 1)).alias("dst_key"), none)
    before = F.lag("key").over(Window.partitionBy("customer").orderBy("ord"))
    amended = a.withColumn("dst_key", before).where("dst_key is not null").select(F.lit("AMENDED_BY").alias("type"), F.col("key").alias("src_key"), "dst_key", none)
    return has.unionByName(ministry).unionByName(area).unionByName(amended)


SQL = """
acts as (
  select 'lov/' || strftime(o_orderdate, '%Y-%m-%d') || '-' || o_orderkey as key, o_orderkey as ord, o_orderpriority as area, o_orderstatus as status, o_custkey as customer from orders),
paragraphs as (
  select a.key || '#paragraf-' || l_linenumber as key, a.key as law_ref_id, 'paragraf-' || l_linenumber as section_id, '§ ' || l_linenumber as paragraph_num, l_linenumber as position,
    'Se § ' || (l_partkey % 7 + 1) || ' og §§ 8, 9.' as content, l_partkey as ord, l_suppkey as ord2 from lineitem l join acts a on l.l_orderkey = a.ord),
relationships as (
  select 'HAS_PARAGRAPH' as type, law_ref_id as src_key, key as dst_key, position::bigint as position from paragraphs
  union all select 'ADMINISTERED_BY', a.key, 'ministry_' || c_nationkey, null from acts a join customer c on a.customer = c.c_custkey
  union all select 'IN_LEGAL_AREA', key, 'area_' || substr(area, 1, 1), null from acts
  union all select 'AMENDED_BY', key, prev, null from (select key, lag(key) over (partition by customer order by ord) as prev from acts) where prev is not null)
"""
