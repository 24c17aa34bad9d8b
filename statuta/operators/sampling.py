"""Bounded samples that are a feature: even spread, worst first, hash order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def even_spread(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """n rows at places floor(i * N / n) of the order; all rows if there are no more than n.

    A range partitioning by the order and counts by partition give every row its place, so no task sorts all rows.
    """
    ranked = with_place(rows, order)
    total = rows.agg(F.count("*").alias("__total"))
    places = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.floor(i * F.col("__total") / n))
    keep = (F.col("__total") <= n) | F.array_contains(places, F.col("place"))
    return ranked.join(F.broadcast(total)).where(keep).drop("__total")


def with_place(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows with place, their number in the order from 0 on. Rows equal in all order columns have neighbouring places.

    Each task sorts one range of the order and numbers its rows; the counts of the ranges, one row each, give where a range begins.
    """
    from pyspark.sql import Window

    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = F.monotonically_increasing_id()  # the partition above 33 bits, the place in it below
    ranged = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("__id", number)
    ranged = ranged.withColumns({"__range": F.shiftright("__id", 33), "__in": F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))})
    counts = ranged.groupBy("__range").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = F.broadcast(counts.select("__range", before.alias("__start")))  # one row a range
    return ranged.join(starts, "__range").withColumn("place", (F.col("__start") + F.col("__in")).cast("long")).drop("__id", "__range", "__in", "__start")


def worst(rows: DataFrame, score: str, tie: str, n: int) -> DataFrame:
    return rows.orderBy(F.col(score).asc(), F.col(tie).asc()).limit(n)


def hash_order(seed: str, key: Column) -> Column:
    return F.md5(F.concat(F.lit(seed), key.cast("string")))


def seeded(rows: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """n rows without replacement, the same for the same seed."""
    return rows.withColumn("__h", hash_order(seed, F.col(key))).orderBy("__h", key).limit(n).drop("__h")


def split_answerable(limit: int, ratio: float) -> tuple[int, int]:
    """How many of limit items are answerable and not, half rounded up; (0, 0) for no limit."""
    if limit <= 0:
        return 0, 0
    n = min(limit, int(ratio * limit + 0.5))
    return n, limit - n
