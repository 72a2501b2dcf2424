"""The shuffle is a permutation, its places can be computed, and shards are even."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import sharding


@pytest.mark.parametrize("rows", [1, 2, 3, 5, 16, 17, 255, 1000, 4097])
def test_permutation_and_inverse(spark, rows):
    permutation = sharding.Permutation(rows, seed=3)
    df = spark.range(rows).select("id", permutation.position(F.col("id")).alias("p"))
    df = df.withColumn("back", permutation.number(F.col("p")))
    found = df.collect()
    assert sorted(r["p"] for r in found) == list(range(rows))
    assert all(r["back"] == r["id"] for r in found)


def test_shards_are_even_reproducible_and_found_again(spark):
    rows = [(i % 90 if i % 7 else None, i % 3, "x") for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, size int, slot string")
    first = sharding.shard(df, ["doc_id", "size"], 16).collect()
    again = sharding.shard(df.repartition(5), ["doc_id", "size"], 16).collect()
    assert len(first) == 500
    slots = {}
    for r in first:
        slots.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(s) for s in slots.values()]
    assert len(slots) == 16 and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())

    def key(rows_of):
        return sorted((str(r["doc_id"]), r["size"], r["shard"], r["slot"]) for r in rows_of)

    assert key(first) == key(again)
    places = spark.createDataFrame([(r["shard"], r["slot"], r["row_number"]) for r in first[:50]], "s int, t long, n long")
    permutation = sharding.Permutation(500)
    wrong = places.where(sharding.row_at(permutation, F.col("s"), F.col("t"), 16) != F.col("n"))
    assert wrong.count() == 0


def test_empty_table(spark):
    assert sharding.shard(spark.createDataFrame([], "doc_id long"), ["doc_id"], 16).count() == 0


def test_hot_key(spark):
    df = spark.range(900).select(F.lit(7).alias("doc_id"))
    found = sharding.shard(df, ["doc_id"], 16).groupBy("shard").count().collect()
    assert {r["count"] for r in found} == {56, 57}


def test_columns_of_any_name_are_kept(spark):
    names = ["seq", "_tie", "_file", "_task", "_place", "_first", "_shift", "tie", "key0", "row", "position", "number"]
    df = spark.createDataFrame([(i, *names) for i in range(40)], "doc_id long, " + ", ".join(f"{n} string" for n in names))
    placed = sharding.shard(df, ["doc_id"], 4).collect()
    assert sorted((r["row_number"], r["doc_id"]) for r in placed) == [(i, i) for i in range(40)]
    assert all([r[n] for n in names] == names for r in placed)
