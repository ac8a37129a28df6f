"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.workspace import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component): for every node of the edges (columns a, b) the smallest node that it is connected with.

    Large and small stars alternate until nothing changes: each node hands its smallest neighbour to its larger, then to its
    smaller neighbours. A step is one aggregation and one join, on edges only; a node with very many neighbours is split by
    adaptive execution in the join and pre-aggregated in the aggregation. Every step is written to the shared folder.
    """
    edges = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    known = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.distinct(), "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stage(least.select("a", F.col("m").alias("b")).unionByName(small).where("a <> b").distinct(), "small")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == known:
            break
        known = state
    best = edges.groupBy("a").agg(F.min("b").alias("component"))
    return nodes.join(best, nodes.node == best.a, "left").select("node", F.coalesce("component", "node").alias("component"))
