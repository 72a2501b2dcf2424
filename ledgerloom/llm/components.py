"""Connected components of an edge table, distributed, by alternating stars.

Each star is a small plan over stored tables, and a round that leaves nothing but stars is the last,
so what the driver keeps of plans and stages stays small.

A node with more than a thousandth of the edges is a hub; there are two thousand at most. What is known
of hubs is sent to their edges, so the edges of a hub are not brought together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.store import stored

#: Nodes of fewer edges are never hubs.
SMALLEST_HUB = 64


def _state(edges: DataFrame) -> tuple[int, bool]:
    """The number of edges, and whether all are stars around their least nodes; every edge has u > v."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select(F.col("v"), F.lit(0), F.lit(1))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    row = nodes.agg(F.sum("up").alias("n"), F.count_if(F.expr("up > 1 OR up > 0 AND down > 0")).alias("open")).first()
    return row["n"] or 0, row["open"] == 0


def _least(edges: DataFrame) -> DataFrame:
    """(u, m, n): the least of each node and those beside it, and its number of edges."""
    return stored(
        edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"), F.count("*").alias("n")), "least"
    )


def _moved(edges: DataFrame, least: DataFrame, hub: int) -> DataFrame:
    """Each edge's far end with the least node beside its near one; ``least`` holds (u, m, n), n edges of u."""
    far = [F.col("v").alias("u"), F.col("m").alias("v")]
    every = least.select("u", "m")
    if (least.agg(F.max("n").alias("n")).first()["n"] or 0) <= hub:
        return edges.join(every, "u").select(*far)
    hubs = F.broadcast(least.where(F.col("n") > hub).select("u", "m"))
    rest = edges.join(hubs.select("u"), "u", "left_anti").join(every, "u")
    return edges.join(hubs, "u").select(*far).union(rest.select(*far))


def _large_star(edges: DataFrame, hub: int) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return stored(_moved(both.where("v > u"), _least(both), hub).distinct(), "large")


def _small_star(edges: DataFrame, hub: int) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    moved = _moved(down, least, hub).union(least.select("u", F.col("m").alias("v")))
    return stored(moved.where("u <> v").distinct(), "stars")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); a component is its least node.

    Rows stay within the number of edges in every round; a node with many edges is
    aggregated before it is joined, and the join may split it. Self loops and nulls
    are left out, so a node with no other edge is not in the result.
    """
    down = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    current = stored(down.distinct(), "edges")
    count, stars = _state(current)
    while not stars:
        # The star between the two has no more edges than there are.
        hub = max(SMALLEST_HUB, count // 1000)
        current = _small_star(_large_star(current, hub), hub)
        count, stars = _state(current)
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
