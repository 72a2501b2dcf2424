"""Hash trees over the byte ranges of append-only files, and checks of a part at a time.

A file's ranges are the leaves of a tree over its addresses: a node covers the addresses that agree
but for their last 16, 32, 48 or 64 bits and hashes its children in order. Address cells
do not move when a file grows, so a commit changes only the nodes above its new ranges, and
two trees that differ are followed from the roots to the ranges that do. A node has as many
children as there are ranges or cells in it, 65,536 at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.ident import sha256_hex

CELL_BITS = 16
LEVELS = 4


def _leaves(segments: DataFrame) -> DataFrame:
    place = F.concat_ws(":", F.col("range_start").cast("string"), F.col("range_end").cast("string"), "sha256")
    return segments.select(
        "source",
        F.lit(0).alias("level"),
        F.col("range_start").alias("node"),
        sha256_hex(place).alias("hash"),
        F.lit(1).cast("bigint").alias("ranges"),
        F.col("range_end").alias("reached"),
    )


def _parents(nodes: DataFrame, level: int) -> DataFrame:
    # The last level is the root: addresses are not negative, so no bits are left.
    cell = F.shiftright("node", CELL_BITS) if level < LEVELS else F.lit(0).cast("bigint")
    children = F.array_sort(F.collect_list(F.struct("node", "hash")))
    named = F.transform(children, lambda child: F.concat_ws(":", child["node"].cast("string"), child["hash"]))
    return nodes.groupBy("source", cell.alias("node")).agg(
        sha256_hex(F.array_join(named, ",")).alias("hash"),
        F.sum("ranges").alias("ranges"),
        F.max("reached").alias("reached"),
    ).select("source", F.lit(level).alias("level"), "node", "hash", "ranges", "reached")


def tree(segments: DataFrame) -> DataFrame:
    """(source, level, node, hash, ranges, reached) of all nodes over (source, range_start, range_end, sha256)."""
    nodes = _leaves(segments)
    every = nodes
    for level in range(1, LEVELS + 1):
        nodes = _parents(nodes, level)
        every = every.unionByName(nodes)
    return every


def roots(segments: DataFrame) -> DataFrame:
    """(source, ranges, reached, root_sha256) of every file."""
    nodes = _leaves(segments)
    for level in range(1, LEVELS + 1):
        nodes = _parents(nodes, level)
    return nodes.select("source", "ranges", "reached", F.col("hash").alias("root_sha256"))


def differing_roots(saved: DataFrame, current: DataFrame) -> DataFrame:
    """Files whose stored root is not that of their stored range hashes."""
    now = current.select("source", F.col("root_sha256").alias("current_sha256"))
    return saved.join(now, "source", "left").where(~F.col("root_sha256").eqNullSafe(F.col("current_sha256")))


def differing_nodes(saved: DataFrame, current: DataFrame) -> DataFrame:
    """(source, level, node) that are in both trees with other hashes, or in one alone."""
    left = saved.select("source", "level", "node", F.col("hash").alias("saved_hash"))
    right = current.select("source", "level", "node", F.col("hash").alias("current_hash"))
    met = left.join(right, ["source", "level", "node"], "full")
    return met.where(~F.col("saved_hash").eqNullSafe(F.col("current_hash"))).select("source", "level", "node")


def due(segments: DataFrame, run: int, period: int) -> DataFrame:
    """The ranges whose turn it is: each comes once in any ``period`` consecutive runs."""
    if period < 1:
        raise ValueError("the period must be at least one run")
    turn: Column = F.pmod(F.xxhash64("source", "range_start") + F.lit(run), F.lit(period))
    return segments.where(turn == 0)
