"""Connected components of an edge table by smallest labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, spread_join


def connected_components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(node, component) for every node of edges (a, b): component is the smallest node reachable.

    Each round takes the smallest label among a node's neighbours and then the label of its label, so long
    chains shrink by halves. Every round is written to the shared folder and reads only the round before.
    """
    both = cut(edges.select("a", "b").union(edges.select("b", "a")).filter("a != b").distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    for _ in range(max_rounds):
        near = spread_join(both.withColumnRenamed("a", "node"), labels, "node").groupBy(F.col("b").alias("node")).agg(F.min("component").alias("near"))
        lower = labels.join(near, "node", "left").select("node", F.col("component").alias("before"), F.least("component", "near").alias("component"))
        # A label may be hot; its own label is one row.
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("next"))
        labels = cut(spread_join(lower, jump, "component", "left").select("node", "before", F.least("component", "next").alias("component")))
        if labels.filter("component < before").isEmpty():
            return labels.select("node", "component")
        labels = labels.select("node", "component")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
