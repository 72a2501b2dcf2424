"""Merkle manifest of a data set: a tree for every group of rows, and one over the groups.

Leaves are numbered in order within their tree over the cluster. At every level each node
sends its digest to the computed indices of its siblings (the index with its last bit flipped
for binary trees, the other slots of the run otherwise), an equijoin on (tree, index) gives every
node the digests beside it, and the nodes in slot zero, which then hold their whole
run, emit the parents. Levels shrink by the arity and are stored. From the top down
a node's proof is what stands beside it and its parent's proof, so a join on the parent's index at
every level gives the rows their proofs; no tree, run of leaves or list of digests is gathered.

Digests are lowercase hex SHA-256; they are kept as bytes and hashed as hex text. A run of
one node still becomes a node of the next level; its part of the proof is empty.

Defined results: null values of a leaf count as ``-``, unlike any text; null trees are a tree of their
own, the first; null order values come first; equal rows are leaves of their own with equal digests, and
their places are interchangeable; an empty table has no leaves, no trees and no root; other
columns are kept inside ``row``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.store import stored
from ledgerloom.operators.groups import numbered
from ledgerloom.session import work_folder

ARITY = 8
_STEPS = "array<struct<left:binary,right:binary>>"


@dataclass(frozen=True)
class Manifest:
    """``leaves``: (row, tree, index, leaf, proof, subroot, root); ``trees``: (tree, size, subroot, proof, root).

    ``tree`` is null for rows without one. A proof lists, from the leaf to the root, the
    digests left and right of the path as bytes.
    """

    leaves: DataFrame
    trees: DataFrame


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenated texts."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes before it, so that no two lists of values look alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    """Digest of a row from the values that count."""
    return digest(*[field(value) for value in values])


def _hex(value: Column) -> Column:
    return F.lower(F.hex(value))


def _siblings(arity: int) -> Column:
    """Indices of the other nodes of a node's run."""
    index = F.col("index")
    if arity == 2:
        others = F.array(index.bitwiseXOR(F.lit(1).cast("bigint")))
    else:
        first = index - index % arity
        others = F.array(*[first + F.pmod(index + shift, F.lit(arity)) for shift in range(1, arity)])
    return F.filter(others, lambda other: other < F.col("size"))


def _beside(nodes: DataFrame, arity: int) -> DataFrame:
    """Add ``left`` and ``right``, the digests of a node's siblings, joined in order."""
    sent = nodes.select(
        "tree",
        F.explode(_siblings(arity)).alias("index"),
        F.struct(F.col("index").alias("at"), "hash").alias("sibling"),
    )
    kept = [F.first(name).alias(name) for name in nodes.columns if name not in ("tree", "index")]
    met = (
        nodes.join(sent, ["tree", "index"], "left")
        .groupBy("tree", "index")
        .agg(*kept, F.sort_array(F.collect_list("sibling")).alias("run"))
    )

    def joined(some: Column) -> Column:
        empty = F.lit(bytearray())
        return F.aggregate(some, empty, lambda total, node: F.concat(total, node["hash"]))

    return met.select(
        *nodes.columns,
        joined(F.filter("run", lambda node: node["at"] < F.col("index"))).alias("left"),
        joined(F.filter("run", lambda node: node["at"] > F.col("index"))).alias("right"),
    )


def _levels(leaves: DataFrame, most: int, arity: int) -> list[DataFrame]:
    """Stored nodes (tree, index, size, hash, left, right) of every level, leaves first."""
    levels = [stored(_beside(leaves, arity), "level0")]
    while most > 1:
        below = levels[-1].where((F.col("size") > 1) & (F.col("index") % arity == 0))
        parents = below.select(
            "tree",
            F.floor(F.col("index") / arity).alias("index"),
            F.ceil(F.col("size") / arity).alias("size"),
            F.unhex(digest(_hex(F.col("hash")), _hex(F.col("right")))).alias("hash"),
        )
        levels.append(stored(_beside(parents, arity), f"level{len(levels)}"))
        most = -(-most // arity)
    return levels


def _tops(levels: Sequence[DataFrame]) -> DataFrame:
    """(tree, hash) of the last node of every tree."""
    tops = [level.where("size = 1").select("tree", "hash") for level in levels]
    every = tops[0]
    for more in tops[1:]:
        every = every.unionByName(more)
    return every


def _proved(levels: Sequence[DataFrame], tops: DataFrame, arity: int) -> DataFrame:
    """Leaves with the proof and other columns of their tree in ``tops`` (tree, proof, ...)."""
    carried = [name for name in tops.columns if name not in ("tree", "proof")]
    above = None
    for level in reversed(levels):
        own = [F.col(f"n.{name}") for name in level.columns if name not in ("left", "right")]
        ended = (
            level.where("size = 1")
            .alias("n")
            .join(tops.alias("t"), F.col("n.tree") == F.col("t.tree"))
            .select(*own, "t.proof", *[f"t.{name}" for name in carried])
        )
        if above is not None:
            step = F.struct("n.left", "n.right")
            upper = (F.col("n.tree") == F.col("p.tree")) & (F.floor(F.col("n.index") / arity) == F.col("p.index"))
            inner = (
                level.where("size > 1")
                .alias("n")
                .join(above.alias("p"), upper)
                .select(*own, F.concat(F.array(step), F.col("p.proof")).alias("proof"), *[f"p.{name}" for name in carried])
            )
            ended = inner.unionByName(ended)
        above = ended.select(*[c for c in ended.columns if c not in ("row", "size", "hash")]) if level is not levels[0] else ended
    return above


def _numbered(rows: DataFrame, order: Sequence[str]) -> tuple[DataFrame, int]:
    """Add ``index`` and ``size`` by tree; also the size of the largest tree."""
    placed = numbered(rows, ["tree"], order, f"{work_folder(rows.sparkSession)}/leaves")
    sizes = stored(placed.groupBy("tree").agg(F.count("*").alias("size")), "sizes")
    most = sizes.agg(F.max("size")).first()[0] or 0
    return placed.join(sizes, "tree").withColumn("index", F.col("seq") - 1), most


def manifest(
    df: DataFrame, leaf: Column, tree: Column | None = None, order: Sequence[Column] = (), arity: int = ARITY
) -> Manifest:
    """The trees over the rows of ``df``, with a proof for every row.

    ``leaf`` gives a row's digest, ``tree`` its tree (text; all rows are one tree without it),
    ``order`` the order of leaves; leaves that tie are ordered by their digests. ``row`` holds
    ``df``'s columns: pass only what the result needs, as it is stored with the leaves.
    """
    named = tree.cast("string") if tree is not None else F.lit("")
    places = [f"order{k}" for k in range(len(order))]
    rows = df.select(
        F.struct("*").alias("row"),
        # Sorts null first, then bytewise.
        F.coalesce(F.concat(F.lit("="), named), F.lit("")).alias("tree"),
        *[value.alias(place) for value, place in zip(order, places, strict=True)],
        F.unhex(leaf).alias("hash"),
    )
    leaves, most = _numbered(stored(rows, "rows"), [*places, "hash"])
    levels = _levels(leaves.select("tree", "index", "size", "hash", "row"), most, arity)
    tops = stored(_tops(levels), "tops")
    upper = tops.select(F.lit("").alias("tree"), "hash", F.struct(F.col("tree").alias("name")).alias("row"), F.col("tree").alias("name"))
    heads, trees = _numbered(upper, ["name"])
    upper_levels = _levels(heads.select("tree", "index", "size", "hash", "row"), trees, arity)
    root = _tops(upper_levels).select("tree", F.array().cast(_STEPS).alias("proof"), F.col("hash").alias("root"))
    proved_trees = stored(
        _proved(upper_levels, root, arity).select(
            F.col("row.name").alias("tree"), "proof", F.col("hash").alias("subroot"), "root"
        ),
        "trees",
    )
    name = F.when(F.col("tree") != "", F.substring("tree", 2, 1 << 30)).alias("tree")
    sizes = levels[0].where("index = 0").select("tree", "size")
    return Manifest(
        _proved(levels, proved_trees, arity).select(
            "row", name, "index", _hex(F.col("hash")).alias("leaf"), "proof",
            _hex(F.col("subroot")).alias("subroot"), _hex(F.col("root")).alias("root"),
        ),
        proved_trees.join(sizes, "tree").select(
            name, "size", _hex(F.col("subroot")).alias("subroot"), "proof", _hex(F.col("root")).alias("root")
        ),
    )


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf's digest gives with a proof."""
    return F.aggregate(proof, leaf, lambda node, step: digest(_hex(step["left"]), node, _hex(step["right"])))


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings of a proof, from the leaf to the root, left to right."""
    parts = F.transform(proof, lambda step: F.concat(_hex(step["left"]), _hex(step["right"])))
    return F.sha2(F.array_join(parts, ""), 256)
