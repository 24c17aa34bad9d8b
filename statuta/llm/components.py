"""Connected components of a list of edges, by smallest label and pointer jumping; nothing but counts reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, table


def components(edges: DataFrame) -> DataFrame:
    """node, label of every node of edges (a, b): label is the smallest node that links reach.

    Each round takes the smallest label among a node and its neighbours, then the label of that label; neighbours' labels are
    pre-aggregated before they are shuffled, so a node with a third of all edges is no burden. An edge to itself only names a node.
    """
    n = 2 * edges.count()
    both = table(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges", n)
    labels = table(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels", n)
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("of")).agg(F.min("label").alias("near"))
        least = labels.join(near, F.col("node") == F.col("of")).select("node", F.col("label").alias("old"), F.least("label", "near").alias("mid"))
        least = table(least, "labels", n)
        jump = least.select(F.col("node").alias("via"), F.col("mid").alias("to"))
        new = table(least.join(jump, F.col("mid") == F.col("via")).select("node", "old", F.least("mid", "to").alias("label")), "labels", n)
        moved = new.where("label <> old").limit(1).count()
        drop(labels, least)
        labels = new
        if not moved:
            drop(both)
            return labels.select("node", "label")
