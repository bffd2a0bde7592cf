"""Connected components of an undirected graph by alternating large-star and small-star steps.

Each step joins every node to the least node it knows of; a node with very many neighbours is a key whose rows are
reduced to a minimum in the map tasks first, and the join back to its neighbours is one that Spark can split.  After
each round the edges are written to the checkpoint folder, so a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetlens.llm.common import checkpointed


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of `edges` (a, b: long): component is the least node it is connected with.

    Repeated edges and loops don't matter; no edges give no rows.
    """
    stars = checkpointed(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct())
    before = None
    for _ in range(rounds):
        # Done when a round changes nothing: then every node has one edge, to a node that has none of its own.
        state = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                stars.select("b", F.col("b")).distinct()
            )
        before = state
        stars = checkpointed(_small_star(_large_star(stars)))
    raise RuntimeError(f"no end after {rounds} rounds")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is joined to the node's least neighbour (or itself)."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a > b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are joined to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()
