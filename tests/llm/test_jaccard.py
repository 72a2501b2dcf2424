"""The similarity join against comparing all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from ledgerloom.llm import jaccard
from tests.llm.test_words import plain


def shingles(text, length):
    found = plain(text)
    if not found:
        return set()
    return {tuple(found[i : i + length]) for i in range(max(1, len(found) - length + 1))}


def brute(rows, length, threshold):
    """(id, size, component) of every row, by all pairs."""
    sets = [(i, shingles(text, length)) for i, text in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            left, right = sets[a][1], sets[b][1]
            if sets[a][0] is None or sets[b][0] is None or not left or not right:
                continue
            if threshold.links(len(left & right), len(left), len(right)):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return sorted(
        ((i, len(s), least[root(k)] if i is not None else None) for k, (i, s) in enumerate(sets)), key=str
    )


def brute_counts(rows, length, threshold):
    """(id, number of other rows linked) of every row, by all pairs."""
    sets = [(i, shingles(text, length)) for i, text in rows]

    def linked(a, b):
        (i, left), (j, right) = sets[a], sets[b]
        if a == b or i is None or j is None or not left or not right:
            return False
        return threshold.links(len(left & right), len(left), len(right))

    every = range(len(sets))
    return sorted(((sets[a][0], sum(linked(a, b) for b in every)) for a in every), key=str)


def near_copies(seed=3, groups=6):
    """Groups of copies and near copies, chains that drift apart, and unrelated texts."""
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(3000)]
    rows, number = [], 0

    def add(text):
        nonlocal number
        rows.append((number, text))
        number += 1

    shared = " ".join(rng.choice(pool) for _ in range(60))
    for group in range(groups):
        base = [rng.choice(pool) for _ in range(rng.choice([5, 12, 40, 150, 400]))]
        for _ in range(12):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, max(1, len(base) // 120), len(base) // 20])):
                copy[rng.randrange(len(copy))] = rng.choice(pool)
            add(" ".join(copy) + ("" if rng.random() < 0.7 else " " + rng.choice(pool)))
        for _ in range(8):
            base[rng.randrange(len(base))] = rng.choice(pool)
            add(" ".join(base))
        add(f"{shared} " + " ".join(rng.choice(pool) for _ in range(20 + group)))
    rows += [(number, None), (number + 1, ""), (number + 2, " \n"), (number + 3, "W1 w2"), (number + 4, "w1 w2")]
    rows += [(2, rows[2][1]), (None, rows[0][1]), (None, None)]
    return rows


@pytest.mark.parametrize(("numerator", "length", "tile"), [(90, 3, 1_000_000), (80, 5, 1_000_000), (80, 3, 600)])
def test_components_match_all_pairs(spark, monkeypatch, numerator, length, tile):
    monkeypatch.setattr(jaccard, "TILE_NGRAMS", tile)
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS key", "2 AS id", "3 AS cell")
    threshold = jaccard.Threshold(numerator)
    found = jaccard.join(df, threshold, length).members
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect()), key=str)
    assert got == brute(rows, length, threshold)


@pytest.mark.parametrize(("numerator", "length", "tile"), [(90, 3, 1_000_000), (80, 5, 1_000_000), (80, 3, 600)])
def test_links_are_counted_as_by_all_pairs(spark, monkeypatch, numerator, length, tile):
    monkeypatch.setattr(jaccard, "TILE_NGRAMS", tile)
    rows = near_copies(4)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n", "2 AS copies", "3 AS n_links")
    threshold = jaccard.Threshold(numerator)
    found = jaccard.join(df, threshold, length, count_links=True).members.collect()
    assert sorted(((r["doc_id"], r["n_links"]) for r in found), key=str) == brute_counts(rows, length, threshold)
    components = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=str)
    assert components == brute(rows, length, threshold)


def test_empty_table(spark):
    found = jaccard.join(spark.createDataFrame([], "doc_id long, text string"), jaccard.Threshold(90), 3)
    assert found.members.columns[:2] == ["doc_id", "n_shingles"]
    assert found.members.count() == 0 and found.links.count() == 0
    counted = jaccard.join(spark.createDataFrame([], "doc_id long, text string"), jaccard.Threshold(90), 3, count_links=True)
    assert counted.members.count() == 0 and "n_links" in counted.members.columns


def test_one_of_each_keeps_the_least_id_and_all_columns(spark):
    rows = near_copies(5)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS _drop", "1 AS count")
    kept = jaccard.one_of_each(df.drop("_drop"), jaccard.Threshold(80), 5)
    expected = {i for i, _, c in brute(rows, 5, jaccard.Threshold(80)) if i is not None and i == c}
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == ["doc_id", "text", "count"]
    assert sorted(i for i in ids if i is not None) == sorted(expected)
    assert ids.count(None) == 2


def test_one_of_each_decides_by_the_text_of_a_repeated_id(spark):
    rng = random.Random(9)

    def text(n=40):
        return " ".join(rng.choice("abcdefghij") + str(rng.randrange(900)) for _ in range(n))

    first, alone, twin, unnamed = text(), text(), text(), text()
    rows = [
        (1, first, "stays"),
        (5, first + " more", "goes"),
        (5, alone, "stays"),
        (5, alone, "one of two"),
        (5, alone.upper(), "one of two"),
        (7, twin, "one of two near"),
        (7, twin + " more", "one of two near"),
        (8, "", "stays"),
        (8, None, "stays"),
        (None, first, "goes if null ids count"),
        (None, unnamed, "one if null ids count"),
        (None, unnamed, "one if null ids count"),
        (None, "", "stays"),
        (None, "", "stays"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, _key string").repartition(3)

    def kept(**options):
        found = jaccard.one_of_each(df, jaccard.Threshold(80), 5, **options)
        assert found.columns == df.columns
        return [(r["doc_id"], (r["text"] or "").lower()) for r in found.collect()]

    def texts(found, i):
        return sorted(t for n, t in found if n == i)

    for options in ({}, {"null_ids": True}):
        found = kept(**options)
        assert texts(found, 1) == [first] and texts(found, 5) == [alone] and texts(found, 8) == ["", ""]
        assert len(texts(found, 7)) == 1 and texts(found, 7)[0].startswith(twin)
        unnamed_texts = ["", "", unnamed] if options else sorted(["", "", first, unnamed, unnamed])
        assert texts(found, None) == unnamed_texts
    single = spark.createDataFrame([(1, first), (2, alone), (None, first)], "doc_id long, text string")
    left = jaccard.one_of_each(single, jaccard.Threshold(80), 5, null_ids=True)
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 2]


def test_every_linked_pair_shares_a_cell():
    rng = random.Random(1)
    for numerator in (90, 80):
        threshold = jaccard.Threshold(numerator)
        for _ in range(800):
            n = rng.choice([4, 5, 9, 12, 18, 19, 30, 50, 100, 300])
            base = np.array([rng.getrandbits(64) for _ in range(n)], np.uint64)
            most = int(threshold.most_differences(np.array([n]))[0])
            gone = rng.randint(0, most)
            more = rng.randint(0, most - gone + 1)
            other = np.concatenate([base[gone:], np.array([rng.getrandbits(64) for _ in range(more)], np.uint64)])
            if not (gone or more) or not threshold.links(n - gone, n, len(other)):
                continue
            cells, owners = jaccard.cells_of([np.unique(base), np.unique(other)], threshold)
            assert set(cells[owners == 0].tolist()) & set(cells[owners == 1].tolist())


def test_tree_finds_all_points_within_the_bound():
    rng = np.random.default_rng(2)
    threshold = jaccard.Threshold(80)
    base = rng.poisson(2, (40, 16))
    vectors = np.concatenate([np.maximum(base + rng.integers(-1, 2, base.shape) * (rng.random(base.shape) < 0.1), 0) for _ in range(9)]).astype(np.int32)
    sizes = vectors.sum(axis=1)
    tree = jaccard.CountTree(vectors, sizes)
    for i in range(0, len(vectors), 7):
        bound = np.minimum(vectors, vectors[i]).sum(axis=1)
        near = (sizes >= threshold.least_partner(sizes[i])) & (sizes * 80 <= sizes[i] * 100)
        expected = np.flatnonzero(near & (bound >= threshold.overlap_needed(int(sizes[i]), sizes)))
        assert np.array_equal(np.sort(tree.search(vectors[i], int(sizes[i]), threshold)), expected)


def test_one_of_each_keeps_columns_of_any_name(spark):
    names = ["_drop", "_row", "_id", "_text", "_key", "component_id", "key"]
    rows = [(i, f"one two three four five six {'seven' if i < 3 else i}", *names) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    for some in (df, df.unionByName(df.where("doc_id = 4"))):
        found = jaccard.one_of_each(some, jaccard.Threshold(80), 5).collect()
        assert sorted(r["doc_id"] for r in found) == [0, 3, 4]
        assert all([r[n] for n in names] == names for r in found)


def test_very_long_texts(spark):
    base = [f"w{i}" for i in range(200_000)]
    changed = list(base)
    changed[1000] = "other"
    rows = [(1, " ".join(base)), (2, " ".join(changed)), (3, " ".join(base[:150_000])), (4, "short text here")]
    found = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"), jaccard.Threshold(90), length=3, count_links=True)
    assert {r["doc_id"]: (r["component_id"], r["n_links"]) for r in found.members.collect()} == {1: (1, 1), 2: (1, 1), 3: (3, 0), 4: (4, 0)}
