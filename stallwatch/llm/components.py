"""Connected components of an undirected graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwatch.llm.scratch import Scratch


def connected_components(edges: DataFrame, scratch: Scratch, name: str, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long); component is its smallest node.

    Alternating large-star and small-star steps: every step keeps the components and pulls edges
    towards the smallest node, so the edges become stars in a logarithmic number of rounds. Each
    step groups by node with a map-side minimum; no neighbourhood is gathered. Each round is a
    written table. Self links and repeated edges are harmless; null ends are dropped.
    """
    both = edges.where("a is not null and b is not null")
    nodes = both.select(F.col("a").alias("node")).unionByName(both.select(F.col("b").alias("node"))).distinct()
    nodes = scratch.table(nodes, f"{name}_nodes")
    now = scratch.table(both.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}_0")
    for i in range(1, max_rounds + 1):
        # Large star: every larger neighbour of a node gets that node's smallest neighbour.
        around = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Written first, so that the join reads two shuffles and Spark can split a node with very many neighbours.
        least = scratch.table(around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), f"{name}_{i}_least")
        large = around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = scratch.table(large, f"{name}_{i}_large")
        # Small star: a node and its smaller neighbours get its smallest neighbour.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        after = scratch.table(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), f"{name}_{i}")
        # Stars: no node is both a child and a centre, and every child has one centre.
        counts = after.groupBy("a").agg(F.count("*").alias("n"), F.min("b").alias("m"))
        tangled = after.select(F.col("b").alias("a")).distinct().join(after, "a", "left_semi").limit(1).count() + counts.where("n > 1").limit(1).count()
        scratch.drop(f"{name}_{i - 1}", f"{name}_{i}_large", f"{name}_{i}_least")
        now = after
        if not tangled:
            break
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    return nodes.join(now.select(F.col("a").alias("node"), "b"), "node", "left").select("node", F.coalesce("b", "node").alias("component"))
