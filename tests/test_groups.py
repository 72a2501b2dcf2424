from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.text import truncate_utf8
from ledgerloom.operators.groups import budgeted_prefix, first_rows, next_fit, numbered

PIECES = ["a", "é", "日", "😀", " "]


def cut(value: str, limit: int) -> str:
    if len(value.encode()) <= limit:
        return value
    if limit < 3:
        return ""
    best = max(n for n in range(len(value) + 1) if len(value[:n].encode()) <= limit - 3)
    return value[:best].rstrip() + "…"


def take(rows: list[tuple[str, str]], max_items: int, item_bytes: int, total: int) -> list[tuple[str, str]]:
    """Plain loop: rows in order until one no longer fits."""
    taken, used = [], 0
    for key, value in rows:
        value = cut(value, item_bytes)
        if len(taken) == max_items:
            break
        if not taken:
            value = cut(value, total)
        elif used + len(value.encode()) > total:
            break
        taken.append((key, value))
        used += len(value.encode())
    return taken


def days(seed: int, count: int = 25) -> dict[int, list[tuple[str, str]]]:
    rng = random.Random(seed)
    return {
        day: [
            (f"{day}-{i:04d}", "".join(rng.choice(PIECES) for _ in range(rng.randrange(0, 25))))
            for i in range(rng.randrange(1, 40))
        ]
        for day in range(count)
    }


def frame(spark, data):
    rows = [(day, key, value) for day, items in data.items() for key, value in items]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "day int, id string, text string")


BOUNDS = [(3, 20, 50), (10, 40, 60), (5, 100, 10), (40, 9, 2), (200, 30, 200), (1, 50, 50)]


@pytest.mark.parametrize("bounds", BOUNDS)
def test_budgeted_prefix(spark, bounds):
    max_items, item_bytes, total = bounds
    data = days(sum(bounds))
    kept = budgeted_prefix(
        frame(spark, data), ["day"], ["id"], lambda c: truncate_utf8(c, item_bytes), max_items, total
    )
    found: dict[int, list] = {}
    for row in kept.orderBy("day", "seq").collect():
        found.setdefault(row["day"], []).append((row["id"], row["bounded"]))
        assert row["bounded_bytes"] == len(row["bounded"].encode())
    assert found == {day: take(rows, max_items, item_bytes, total) for day, rows in data.items()}


@pytest.mark.parametrize("bounds", BOUNDS)
@pytest.mark.parametrize("max_batches", [1, 4, 32])
def test_next_fit_repeats_the_prefix(spark, bounds, max_batches):
    max_items, item_bytes, total = bounds
    data = days(sum(bounds) + 1)
    batched = next_fit(
        frame(spark, data), ["day"], ["id"], lambda c: truncate_utf8(c, item_bytes), max_items, total, max_batches
    )
    found = {
        (row["day"], row["batch_no"], row["item_no"]): (row["id"], row["bounded"]) for row in batched.collect()
    }
    wanted = {}
    for day, rows in data.items():
        left = list(rows)
        for number in range(1, max_batches + 1):
            taken = take(left, max_items, item_bytes, total)
            wanted.update({(day, number, i): item for i, item in enumerate(taken, start=1)})
            left = left[len(taken):]
    assert found == wanted


def hot(spark, rows: int = 20_000):
    """One day holds all but a few rows."""
    return spark.range(rows).select(
        F.when(F.col("id") < 5, F.col("id").cast("int")).otherwise(99).alias("day"),
        F.sha2(F.col("id").cast("string"), 256).alias("id"),
        F.lit("x").alias("text"),
    )


def test_first_rows_of_a_hot_group(spark):
    found = first_rows(hot(spark), ["day"], ["id"], 50).where("day = 99").orderBy("seq").collect()
    wanted = [r["id"] for r in hot(spark).where("day = 99").orderBy("id").limit(50).collect()]
    assert [r["id"] for r in found] == wanted and [r["seq"] for r in found] == list(range(1, 51))


def test_rows_are_limited_before_the_shuffle(spark):
    plan = first_rows(hot(spark), ["day"], ["id"], 50)._jdf.queryExecution().executedPlan().toString()
    first_exchange = plan.rindex("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[first_exchange:]


def test_numbered_hot_group(spark, tmp_path):
    found = numbered(hot(spark), ["day"], ["id"], str(tmp_path / "sorted")).select("day", "id", "seq").collect()
    wanted = {}
    for row in sorted(hot(spark).collect(), key=lambda r: (r["day"], r["id"])):
        wanted.setdefault(row["day"], []).append(row["id"])
    assert len(found) == 20_000
    assert all(wanted[r["day"]][r["seq"] - 1] == r["id"] for r in found)
