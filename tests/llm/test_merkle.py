"""Trees against a plain construction, and proofs against tampering."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import merkle

SCHEMA = "id long, name string, text string, tree string, hash string, row string, size long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(*values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(leaves, arity):
    """The root, and for each leaf the siblings (left, right) of every level."""
    proofs, places = [[] for _ in leaves], list(range(len(leaves)))
    level = list(leaves)
    while len(level) > 1:
        for k, place in enumerate(places):
            run = place // arity * arity
            proofs[k].append((level[run:place], level[place + 1 : run + arity]))
            places[k] = place // arity
        level = [h(*level[i : i + arity]) for i in range(0, len(level), arity)]
    return level[0], proofs


def plain(rows, arity):
    """(id, text) -> sorted (leaf, subroot, root, proof digest)."""
    groups = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r[0], r[2]))):
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    made = {n: plain_tree([plain_leaf(r[0], r[2]) for r in groups[n]], arity) for n in names}
    root, tops = plain_tree([made[n][0] for n in names], arity)
    found = []
    for n, top in zip(names, tops, strict=True):
        for r, proof in zip(groups[n], made[n][1], strict=True):
            beside = [node for left, right in proof + top for node in left + right]
            found.append((plain_leaf(r[0], r[2]), made[n][0], root, h(*beside)))
    return sorted(found)


def rows_of(counts):
    rows, number = [], 0
    for name, count in counts.items():
        for _ in range(count):
            rows.append((number, name, f"text {number} é" if number % 5 else None, "t", "x", "r", 1))
            number += 1
    return rows


def built(spark, rows, arity=8):
    df = spark.createDataFrame(rows, SCHEMA)
    leaf = merkle.leaf_of(F.col("id"), F.col("text"))
    return merkle.manifest(df, leaf, F.col("name"), [F.col("id")], arity)


@pytest.mark.parametrize("arity", [2, 3, 8])
def test_against_a_plain_construction(spark, arity):
    counts = {None: 1, "": 2, "a": 8, "b": 9, "é": 65, "z": 3, "Z": 1, "y": 17, "x": 4, "w": 2}
    rows = rows_of(counts)
    made = built(spark, rows, arity)
    found = made.leaves.select("leaf", "subroot", "root", merkle.proof_digest(F.col("proof"))).collect()
    assert sorted(map(tuple, found)) == plain(rows, arity)
    kept = {(r["row"]["id"], r["row"]["tree"], r["row"]["hash"], r["tree"]) for r in made.leaves.collect()}
    assert kept == {(r[0], "t", "x", r[1]) for r in rows}
    assert {(r["tree"], r["size"]) for r in made.trees.collect()} == set(counts.items())


def test_proofs_show_tampering(spark):
    rows = rows_of({"a": 20, "b": 1})
    made = built(spark, rows)
    changed = F.when(F.col("row.id") % 3 == 0, F.upper("row.text")).otherwise(F.col("row.text"))
    folded = merkle.folded(merkle.leaf_of(F.col("row.id"), changed), F.col("proof"))
    for r in made.leaves.select("row.id", "row.text", (folded == F.col("root")).alias("same")).collect():
        assert r["same"] == (r["id"] % 3 != 0 or r["text"] is None)
    trees = made.trees.select((merkle.folded(F.col("subroot"), F.col("proof")) == F.col("root")).alias("same"))
    assert all(r["same"] for r in trees.collect())


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, None, None, "", "", "", 0)] * 3 + [(1, None, "a", None, None, None, None)] * 9 + [(1, None, "b", "", "", "", 0)]
    made = built(spark, rows).leaves
    found = made.select("leaf", "subroot", "root", merkle.proof_digest(F.col("proof"))).collect()
    assert sorted(map(tuple, found)) == plain(rows, 8)


def test_one_row_one_tree_and_none(spark):
    one = built(spark, rows_of({"a": 1})).leaves.first()
    assert one["leaf"] == one["subroot"] == one["root"] and one["proof"] == []
    made = built(spark, rows_of({"a": 1})[:0] or [rows_of({"a": 1})[0]])
    assert made.leaves.count() == 1
    df = spark.createDataFrame([], SCHEMA)
    none = merkle.manifest(df, merkle.leaf_of(F.col("id")), F.col("name"), [F.col("id")])
    assert none.leaves.count() == 0 and none.trees.count() == 0
    whole = merkle.manifest(spark.createDataFrame(rows_of({"a": 3, None: 2}), SCHEMA), merkle.leaf_of(F.col("id")), order=[F.col("id")])
    assert {(r["tree"], r["size"]) for r in whole.trees.collect()} == {("", 5)}


def test_long_texts_and_lengths(spark):
    text = "é" * 300_000
    df = spark.createDataFrame([(1, text), (2, "")], "id long, text string")
    found = {r["id"]: r["l"] for r in df.select("id", merkle.leaf_of(F.col("id"), F.col("text")).alias("l")).collect()}
    assert found == {1: plain_leaf(1, text), 2: plain_leaf(2, "")}
