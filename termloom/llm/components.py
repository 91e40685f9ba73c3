"""Connected components of a graph of edges, by alternating stars.

Each round joins every node's larger neighbours to its smallest one (large
star), then its smaller ones (small star). Edges never become more, and after a
number of rounds that grows with the logarithm of the graph every node has one
edge, to the smallest node of its component. Nothing but an edge is ever held
for a node: minima are taken by aggregation, and joined back by joins that
adaptive execution can split at a hot node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.plans.workspace import Workspace

MAX_ROUNDS = 50


def connected_components(edges: DataFrame, workspace: Workspace) -> DataFrame:
    """(node, label) of every node that has an edge; label is the smallest node.

    ``edges`` has two columns of one type that can be ordered. Loops, repeated
    edges, edges in either direction and nulls do not matter.
    """
    first, second = (F.col(name) for name in edges.columns)
    stars = workspace.save(
        edges.filter(first != second)
        .select(F.greatest(first, second).alias("node"), F.least(first, second).alias("label"))
        .distinct(),
        "edges",
    )
    before = None
    for _ in range(MAX_ROUNDS):
        stars = _small_star(_large_star(stars, workspace), workspace)
        state = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "label"))).first()
        if state == before:
            labels = stars.select("label").distinct().select(F.col("label").alias("node"), "label")
            return stars.unionByName(labels)
        before = state
    raise RuntimeError(f"components are not found after {MAX_ROUNDS} rounds")


def _large_star(stars: DataFrame, workspace: Workspace) -> DataFrame:
    """Each node's larger neighbours to the smallest of its neighbours and itself."""
    both = stars.unionByName(stars.select(F.col("label").alias("node"), F.col("node").alias("label")))
    smallest = workspace.save(
        both.groupBy("node").agg(F.least(F.col("node"), F.min("label")).alias("smallest")), "minima"
    )
    joined = both.join(smallest, "node").filter(F.col("label") > F.col("node"))
    return workspace.save(
        joined.select(F.col("label").alias("node"), F.col("smallest").alias("label")).distinct(), "large"
    )


def _small_star(stars: DataFrame, workspace: Workspace) -> DataFrame:
    """Each node's smaller neighbours, and itself, to the smallest of them."""
    smallest = workspace.save(stars.groupBy("node").agg(F.min("label").alias("smallest")), "minima")
    moved = (
        stars.join(smallest, "node")
        .filter(F.col("label") != F.col("smallest"))
        .select(F.col("label").alias("node"), F.col("smallest").alias("label"))
    )
    kept = smallest.select("node", F.col("smallest").alias("label"))
    return workspace.save(moved.unionByName(kept).distinct(), "small")
