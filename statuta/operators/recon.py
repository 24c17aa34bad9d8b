"""Reconciliation of a seed with a live store: manifest differences, gaps, property changes, date retyping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuta.functions import dates


def manifest_diff(old: DataFrame, new: DataFrame, key: str = "ref_id", digest: str = "sha256") -> DataFrame:
    """key and status: added, removed, changed or unchanged."""
    o, n = old.select(F.col(key), F.col(digest).alias("__o")), new.select(F.col(key).alias("__k"), F.col(digest).alias("__n"))
    joined = o.join(n, F.col(key) == F.col("__k"), "full_outer")
    status = F.when(F.col(key).isNull(), "added").when(F.col("__k").isNull(), "removed").when(F.col("__o") != F.col("__n"), "changed").otherwise("unchanged")
    return joined.select(F.coalesce(key, "__k").alias(key), status.alias("status"))


def missing_objects(seed: DataFrame, live: DataFrame) -> DataFrame:
    return seed.join(live.select("key").distinct(), "key", "left_anti")


def missing_edges(seed: DataFrame, live_objects: DataFrame, live_edges: DataFrame) -> DataFrame:
    """type, src_key, dst_key of seed edges whose ends are live, that are no loops, and that the store lacks. live ids by key."""
    ids = live_objects.select("key", "id").distinct()
    src, dst = ids.toDF("src_key", "src_id"), ids.toDF("dst_key", "dst_id")
    known = seed.join(src, "src_key").join(dst, "dst_key").where("src_id <> dst_id").select("type", "src_key", "dst_key", "src_id", "dst_id").distinct()
    return known.join(live_edges.select("type", "src_id", "dst_id"), ["type", "src_id", "dst_id"], "left_anti").select("type", "src_key", "dst_key")


def property_delta(seed: DataFrame, live: DataFrame, columns: list[str], managed: list[str] | None = None) -> DataFrame:
    """key, prop, action (set or delete), value of each property that differs; dates equal by day are no difference."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("prop"), F.col(f"s.{c}").cast("string").alias("seed"), F.col(f"l.{c}").cast("string").alias("live")) for c in managed or columns))).alias("p")
    both = seed.alias("s").join(live.alias("l"), F.col("s.key") == F.col("l.key")).select(F.col("s.key").alias("key"), pairs)
    s, v = F.col("p.seed"), F.col("p.live")
    action = F.when(s.isNull() & v.isNotNull(), "delete").when(s.isNotNull() & ~s.eqNullSafe(v) & ~F.coalesce(dates.same_day(s, v), F.lit(False)), "set")
    return both.withColumn("action", action).where("action is not null").select("key", F.col("p.prop").alias("prop"), "action", F.when(F.col("action") == "set", s).alias("value"))


def retype_candidates(seed: DataFrame, live: DataFrame, column: str) -> DataFrame:
    """key, seed and live value of dates that the store holds in a plain form; none on a second run."""
    l = live.select("key", F.col(column).alias("live_value"))
    both = seed.select("key", F.col(column).alias("seed_value")).join(l, "key")
    return both.where(dates.parse(F.col("seed_value")).isNotNull() & F.col("live_value").isNotNull() & ~dates.is_live_form(F.col("live_value")))
