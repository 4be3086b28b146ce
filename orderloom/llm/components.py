"""Connected components of an undirected graph by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import stored, stored_with


def _with_least(links: DataFrame) -> DataFrame:
    """``u``, ``v`` and the least of u and all its neighbours.

    The least are written first, as AQE splits crowded nodes only in a join of plain tables.
    """
    least = links.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
    return links.join(stored(least, "component-least"), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie every greater neighbour of a node to the node's least neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie a node and its lesser neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    tied = _with_least(down)
    own = tied.select("u", F.col("least").alias("v"))
    return own.union(tied.select(F.col("v").alias("u"), F.col("least").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``u`` and its component ``v``, the least node, for every node that isn't its component's least.

    ``edges`` has two columns u, v of ids; loops and repeats are allowed. Each round's edges are written to the shared
    folder; the rounds end when the edges stay the same.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    state = None
    while True:
        edges, found = stored_with(
            _small_star(_large_star(edges)),
            "component-edges",
            n=F.count(F.lit(1)),
            sum=F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
        )
        if found == state or not found["n"]:
            return edges
        state = found
