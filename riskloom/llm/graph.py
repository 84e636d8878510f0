"""Connected components of an undirected graph by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(a, b) -> (node, component): the smallest node reachable, for every node with an edge.

    Each round takes the smallest label among a node and its neighbours and then jumps to the label of
    that label, so long chains halve.  Labels are written to the shared folder after each round; both
    sides of each join are plain scans, which adaptive execution can split where one node is hot.
    """
    both = materialise(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).where("a <> b").distinct(), "edges")
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("component")), "labels")
    for _ in range(max_rounds):
        heard = both.join(labels.select(F.col("node").alias("b"), F.col("component").alias("heard")), "b").groupBy(F.col("a").alias("node")).agg(F.min("heard").alias("heard"))
        near = labels.join(heard, "node").select("node", F.col("component").alias("old"), F.least("component", "heard").alias("component"))
        root = labels.select(F.col("node").alias("component"), F.col("component").alias("root"))
        jumped = materialise(near.join(root, "component").select("node", "old", F.col("root").alias("component")), "labels")
        labels = jumped.select("node", "component")
        if jumped.where("old <> component").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
