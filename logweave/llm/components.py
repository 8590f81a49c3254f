"""Connected components of a large graph by alternating large-star and small-star steps.

Both steps are joins with a per-node minimum, which is combined inside map tasks;
no step gathers the neighbours of a node, so a hub costs as much as its edges.
Edges are written to the shared folder after every round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import stored


def _pointed(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with a > b, each once."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter(
        "a <> b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"),
                                                        F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    joined = edges.join(least, "a")
    return joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
        least.select("a", F.col("least").alias("b")))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); component: its least node.

    No edges: an empty result.
    """
    current = stored(_pointed(edges), f"{name}-0")
    last, turn = None, 0
    while True:
        turn += 1
        current = stored(_pointed(_small_star(_pointed(_large_star(current)))), f"{name}-{turn}")
        # stars only: no node both points and is pointed to; the sums then stay as they are
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == last:
            break
        last = tuple(state)
    pointing = current.groupBy("a").agg(F.min("b").alias("component"))
    roots = current.select(F.col("b").alias("node")).distinct()
    return pointing.select(F.col("a").alias("node"), "component").unionByName(
        roots.join(pointing.select(F.col("a").alias("node")), "node", "left_anti")
        .select("node", F.col("node").alias("component")))
