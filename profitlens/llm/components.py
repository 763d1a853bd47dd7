"""Connected components of a graph that no single task or driver holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profitlens.llm._common import staged


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(pairs: DataFrame, keep) -> DataFrame:
    """Tie each neighbour of a node to the smallest of the node and its neighbours. pairs: (a, b), b a neighbour of a;
    keep: which of the pairs get a new edge."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (pairs.where(keep).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a != b"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node of its component.

    Alternating large-star and small-star steps until nothing changes; the number of steps grows with the logarithm of
    the nodes. Each step is written to the shared folder, so no lineage builds up and a lost executor costs one step.
    Edges may repeat, be loops or come in both directions; no edges: no rows."""
    cur = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .where("a != b").distinct(), "cc")
    before = None
    while True:
        sign = cur.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(sign) == before or not sign[0]:
            break
        before = tuple(sign)
        large = _star(_both(cur), F.col("b") > F.col("a")).distinct()
        large = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        cur = staged(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc")
    nodes = cur.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return nodes.unionByName(nodes.select(F.col("root").alias("node"), "root").distinct())
