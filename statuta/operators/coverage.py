"""How much of a source a model of it holds: multiset token recall and its summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statuta.functions.text import tokens


def token_recall(source: DataFrame, model: DataFrame, key: str) -> DataFrame:
    """key, total, kept, coverage: tokens of the source's text that the model's text also has, counted with repeats; 1 without tokens."""

    def counts(df: DataFrame, n: str) -> DataFrame:
        return df.select(key, F.explode(tokens(F.col("text"))).alias("token")).groupBy(key, "token").agg(F.count("*").alias(n))

    both = counts(source, "a").join(counts(model, "b"), [key, "token"], "left")
    per = both.groupBy(key).agg(F.sum("a").alias("total"), F.sum(F.least("a", F.coalesce("b", F.lit(0)))).alias("kept"))
    out = source.select(key).distinct().join(per, key, "left")
    return out.select(key, F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept"), F.coalesce(F.col("kept") / F.col("total"), F.lit(1.0)).alias("coverage"))


def summary(rows: DataFrame) -> DataFrame:
    """documents, mean, least and how many are below 0.99 and 0.95; zeros for no rows."""
    c = F.col("coverage")
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    return rows.agg(F.count("*").alias("documents"), zero(F.avg(c)).alias("mean"), zero(F.min(c)).alias("least"), F.count_if(c < 0.99).alias("below_99"), F.count_if(c < 0.95).alias("below_95"))
