"""Targets and takings of the mix."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import mixing


def brute_targets(sizes, recipe):
    """Reshare the excess until no source is above its most."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: recipe.weights[k % len(recipe.weights)] for k, s in enumerate(names)}
    budget, full = recipe.share * sum(sizes.values()), {}
    while True:
        open_names = [s for s in names if s not in full]
        left = budget - sum(full.values())
        total = sum(weight[s] for s in open_names)
        over = [s for s in open_names if weight[s] * left / total > recipe.repeats * sizes[s]]
        if not over:
            return full | {s: weight[s] * left / total for s in open_names}
        full |= {s: recipe.repeats * sizes[s] for s in over}


def table(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["a", "b", "ä", "Z", "zz", None]), "w " * rng.randint(0, 30), 1) for i in range(900)]
    rows += [(1000 + i, "hot", "w " * rng.randint(1, 9), 1) for i in range(1500)]
    rows += [(7, "same", "x y z", 1)] * 400 + [(None, "a", None, 1), (1, "none", None, 1)]
    return spark.createDataFrame(rows, "doc_id long, source string, text string, copies int").repartition(7)


@pytest.mark.parametrize("bits", [10, 2])
def test_mix_meets_its_targets(spark, monkeypatch, bits):
    monkeypatch.setattr(mixing, "BITS", bits)
    df = table(spark)
    rows = mixing.mix(df).collect()
    assert len(rows) == df.count()
    sizes, taken, goals, largest = {}, {}, {}, {}
    for r in rows:
        s = r["source"]
        assert r["size"] == len((r["text"] or "").split())
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
        goals[s] = r["target"]
        largest[s] = max(largest.get(s, 0), r["size"])
        assert (r["source_size"] > 0) == (s != "none")
    expected = brute_targets(sizes, mixing.Recipe())
    for s, goal in goals.items():
        assert goal == pytest.approx(expected[s])
        # With few bits, texts of one hash can be told apart by their place only.
        assert abs(taken[s] - goal) <= largest[s]


def test_reruns_agree_and_seeds_differ(spark):
    df = table(spark)

    def chosen(seed):
        return sorted((r["doc_id"] or 0, r["taken"]) for r in mixing.mix(df, seed=seed).collect())

    assert chosen(0) == chosen(0)
    assert chosen(0) != chosen(1)


def test_mixed_rows_repeat(spark):
    df = table(spark)
    total = mixing.mix(df).agg(F.sum("copies")).first()[0]
    rows = mixing.mixed(df)
    assert rows.columns == df.columns and rows.count() == total


def test_empty_table(spark):
    assert mixing.mix(table(spark).limit(0)).count() == 0


def test_columns_of_any_name_are_kept(spark):
    names = ["t1", "t2", "whole", "_source", "_k1", "_k2", "_row", "_from", "_id", "_text", "left", "start"]
    rows = [(i, f"s{i % 3}", "w " * (i % 5), *names) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, " + ", ".join(f"{n} string" for n in names))
    mixed = mixing.mix(df).collect()
    plain = {r["doc_id"]: r["taken"] for r in mixing.mix(df.select("doc_id", "source", "text")).collect()}
    assert len(mixed) == 30
    for r in mixed:
        assert [r[n] for n in names] == names and r["taken"] == plain[r["doc_id"]]
    assert mixing.mixed(df).columns == df.columns


def test_very_long_texts(spark):
    rows = [(1, "a", "word " * 500_000), (2, "a", "word"), (3, "b", "x y z")]
    found = {r["doc_id"]: (r["size"], r["taken"]) for r in mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()}
    assert found[1][0] == 500_000 and all(taken in (0, size, 2 * size) for size, taken in found.values())
