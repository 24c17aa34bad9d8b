"""Objects and relationships: first-wins dedupe, property merge, endpoint filters, stubs, variants, traversal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedupe_first(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key; the window keeps one candidate a partition before it shuffles."""
    return rows.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__rn = 1").drop("__rn")


def merge_properties(edges: DataFrame, keys: list[str], prop: str, value: str, order: list[str]) -> DataFrame:
    """One row for each edge and property with the first value; aggregated before the shuffle, so hot edges are no burden."""
    return edges.where(F.col(value).isNotNull()).groupBy(*keys, prop).agg(F.min_by(value, F.struct(*order)).alias(value))


def as_map(rows: DataFrame, keys: list[str], prop: str, value: str) -> DataFrame:
    """Merged properties as one map for each edge, its keys sorted."""
    return rows.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(prop, value)))).alias("properties"))


def endpoint_filter(edges: DataFrame, objects: DataFrame) -> DataFrame:
    """Edges between two different objects that exist."""
    keys = objects.select("key").distinct()
    return (
        edges.where("src_key <> dst_key").join(keys.withColumnRenamed("key", "src_key"), "src_key", "left_semi").join(keys.withColumnRenamed("key", "dst_key"), "dst_key", "left_semi")
    )


def stubs(needed: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Distinct keys that are referred to but not known."""
    return needed.select(key).where(F.col(key).isNotNull()).distinct().join(known.select(key), key, "left_anti")


def variant_pairs(rows: DataFrame, group: str, order: str) -> DataFrame:
    """Pairs of rows of a group, the earlier first; rows without group have none."""
    a = rows.where(F.col(group).isNotNull()).select(F.col(group), F.col(order).alias("source"))
    b = rows.select(F.col(group), F.col(order).alias("target"))
    return a.join(b, group).where("source < target")


def two_hop(edges: DataFrame, first: str, second: str) -> DataFrame:
    """start, middle, end along two types of edges."""
    a = edges.where(F.col("type") == first).select(F.col("src_key").alias("start"), F.col("dst_key").alias("middle"))
    b = edges.where(F.col("type") == second).select(F.col("src_key").alias("middle"), F.col("dst_key").alias("end"))
    return a.join(b, "middle").select("start", "middle", "end")


def reach(edges: DataFrame, start: DataFrame, depth: int) -> DataFrame:
    """node, depth of all nodes within so many steps, each at its smallest depth. edges: a, b.

    Each round joins the frontier only and drops nodes seen. Where the session names a checkpoint folder a frontier is written there,
    so that no round computes the earlier ones again; nothing but plans is kept on the driver.
    """
    written = start.sparkSession.conf.get("spark.checkpoint.dir", None) is not None
    frontier = start.select("node").distinct().withColumn("depth", F.lit(0))
    seen = frontier = frontier.checkpoint() if written else frontier
    for k in range(1, depth + 1):
        step = edges.join(frontier.select("node"), edges["a"] == F.col("node"), "left_semi").select(F.col("b").alias("node")).distinct()
        frontier = step.join(seen.select("node"), "node", "left_anti").withColumn("depth", F.lit(k))
        frontier = frontier.checkpoint() if written else frontier
        seen = seen.union(frontier)
    return seen


def type_counts(rows: DataFrame, kind: str = "type") -> DataFrame:
    return rows.groupBy(kind).agg(F.count("*").alias("n"))


def amendment_key(law: Column, by: Column, provision: Column, source: Column) -> Column:
    from statuta.functions.text import key_part

    return F.concat(F.lit("amend_"), key_part(law), F.lit("_"), key_part(by), F.lit("_"), key_part(provision), F.lit("_"), key_part(source))
