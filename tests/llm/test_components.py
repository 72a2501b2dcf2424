"""Components against a plain search, with hubs and without."""

from __future__ import annotations

import random

import pytest

from ledgerloom.llm import components as module


def plain(edges):
    parent = {}

    def root(node):
        parent.setdefault(node, node)
        while parent[node] != node:
            node = parent[node]
        return node

    for u, v in edges:
        if u is not None and v is not None and u != v:
            a, b = sorted((root(u), root(v)))
            parent[b] = a
    return {node: root(node) for node in parent}


@pytest.mark.parametrize("smallest", [2, 64])
def test_components_with_hubs(spark, monkeypatch, smallest):
    monkeypatch.setattr(module, "SMALLEST_HUB", smallest)
    rng = random.Random(smallest)
    edges = [(1000, n) for n in range(1001, 1300)] + [(n, 5) for n in range(2000, 2200)] + [(5, 1100)]
    edges += [(n, n + 1) for n in range(3000, 3040)] + [(rng.randrange(4000, 4100), rng.randrange(4000, 4100)) for _ in range(60)]
    edges += [(7, 7), (None, 3), (9, None), (1000, 1001)]
    df = spark.createDataFrame(edges, "u long, v long").repartition(3)
    found = [tuple(r) for r in module.components(df).collect()]
    assert sorted(found) == sorted(plain(edges).items())
    assert module.components(df.where("false")).count() == 0


def test_plans_stay_small(spark, monkeypatch):
    """What is stored in a round comes from few reads of what was stored before, however hubs are treated."""
    monkeypatch.setattr(module, "SMALLEST_HUB", 2)
    reads = []
    write = module.stored

    def counting(df, name):
        reads.append(df._jdf.queryExecution().optimizedPlan().toString().count("Relation ["))
        return write(df, name)

    monkeypatch.setattr(module, "stored", counting)
    edges = [(n, n + 1) for n in range(20)] + [(100, n) for n in range(101, 140)] + [(139, 5)]
    df = spark.createDataFrame(edges, "u long, v long")
    assert dict(map(tuple, module.components(df).collect())) == plain(edges)
    assert max(reads) <= 10


def test_stars_need_no_round(spark, monkeypatch):
    monkeypatch.setattr(module, "_small_star", None)
    edges = [(n, 3) for n in range(4, 90)] + [(100, 101), (102, 100)]
    found = module.components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert dict(map(tuple, found)) == plain(edges)
