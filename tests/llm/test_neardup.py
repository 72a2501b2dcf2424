"""Links of vectors against all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from ledgerloom.llm import neardup


def vectors(seed=1, dim=24):
    rng = np.random.default_rng(seed)
    rows, number = [], 0

    def add(vector, label):
        nonlocal number
        rows.append((number, [None if x is None else float(x) for x in vector] if vector is not None else None, label))
        number += 1

    for label in (0, 1, None):
        for _ in range(25):
            base = rng.standard_normal(dim)
            add(base, label)
            for scale in (0.02, 0.15, 0.19, 0.3):
                noise = rng.standard_normal(dim)
                add(base + scale * np.linalg.norm(base) * noise / np.linalg.norm(noise), label)
    common = rng.standard_normal(dim)
    for _ in range(60):
        add(common, 1)
        add(common + 0.01 * rng.standard_normal(dim), 1)
    add(common * 1e200, 1)
    add(np.zeros(dim), 1)
    add([*common[:-1], np.nan], 1)
    add([*common[:-1], np.inf], 1)
    add([*common[:-1], None], 1)
    add(None, 1)
    add([], 1)
    add(common[:5], 1)
    add(common[:5], 1)
    rows.append((None, [float(x) for x in common], 1))
    rows.append((0, rows[0][1], rows[0][2]))
    return rows


def usable(row):
    number, vector, label = row
    return (
        number is not None and label is not None and vector
        and all(x is not None and np.isfinite(x) for x in vector) and any(vector)
    )


def brute(rows, cosine=0.98):
    n = len(rows)
    unit = [np.array(r[1]) / np.abs(r[1]).max() if usable(r) else None for r in rows]
    unit = [None if u is None else u / np.linalg.norm(u) for u in unit]
    parent, links = list(range(n)), [0] * n

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(n):
        for b in range(a):
            if unit[a] is None or unit[b] is None or rows[a][2] != rows[b][2] or len(unit[a]) != len(unit[b]):
                continue
            if unit[a] @ unit[b] >= cosine:
                links[a] += 1
                links[b] += 1
                parent[root(a)] = root(b)
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[root(k)] = min(least.get(root(k), r[0]), r[0])
    return sorted(((r[0], links[k], least[root(k)] if r[0] is not None else None) for k, r in enumerate(rows)), key=str)


@pytest.mark.parametrize("tile", [2000, 15])
def test_links_match_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(neardup, "TILE", tile)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS cls", "2 AS n_links")
    found = neardup.join(df).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in found), key=str) == brute(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found if r["vec_id"] is not None)


def test_recall_at_the_threshold():
    rng = np.random.default_rng(5)
    plan = neardup.Plan.of(100_000, 0.98, 1e-3)
    left = rng.standard_normal((2000, 32))
    left /= np.linalg.norm(left, axis=1, keepdims=True)
    side = rng.standard_normal(left.shape)
    side -= (side * left).sum(axis=1, keepdims=True) * left
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    right = 0.98 * left + np.sqrt(1 - 0.98**2) * side
    met = (neardup._buckets(left, plan) == neardup._buckets(right, plan)).any(axis=1)
    assert met.mean() > 0.99


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert neardup.join(df).count() == 0
