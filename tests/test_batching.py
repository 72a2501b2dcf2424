"""Whole-group batches against the plain loop, at any block size, and what the plans move."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.bounds import PacketBounds
from ledgerloom.functions.text import truncate_utf8
from ledgerloom.operators import batching, packets
from ledgerloom.operators.groups import budgeted_prefix, chosen_rows, next_fit
from tests.test_groups import BOUNDS, days, frame, take


def plain(rows, max_items, item_bytes, total):
    left, number, found = list(rows), 0, []
    while left:
        number += 1
        taken = take(left, max_items, item_bytes, total)
        found += [(key, number, i) for i, (key, _) in enumerate(taken, start=1)]
        left = left[len(taken):]
    return found


@pytest.mark.parametrize("bounds", BOUNDS)
@pytest.mark.parametrize("block_rows", [1, 16, 1000])
def test_batches_of_whole_groups(spark, bounds, block_rows):
    max_items, item_bytes, total = bounds
    rng = random.Random(sum(bounds) + block_rows)
    data = {
        day: [(f"{day}-{i:05d}", "x" * rng.choice([0, 1, 3, 10, 30])) for i in range(rng.choice([1, 2, 7, 50, 300]))]
        for day in range(9)
    }
    found = batching.whole_batches(
        frame(spark, data), ["day"], ["id"], lambda c: truncate_utf8(c, item_bytes), max_items, total, block_rows=block_rows
    )
    rows = {(r["day"], r["id"]): (r["batch_no"], r["item_no"]) for r in found.collect()}
    wanted = {(day, k): (b, i) for day, items in data.items() for k, b, i in plain(items, max_items, item_bytes, total)}
    assert rows == wanted


def test_a_day_of_many_batches(spark):
    sizes = [(seq, (seq * 7919) % 40 + 1) for seq in range(1, 20_001)]
    rows = spark.createDataFrame([(1, seq, size, size) for seq, size in sizes], "day int, seq long, size long, alone long")
    found = batching.number_batches(rows, ["day"], 10, 100, block_rows=100).orderBy("seq").collect()
    batch, item, used = 0, 0, 0
    for row, (_, size) in zip(found, sizes, strict=True):
        if batch == 0 or item >= 10 or used + size > 100:
            batch, item, used = batch + 1, 0, 0
        item, used = item + 1, used + size
        assert (row["batch_no"], row["item_no"]) == (batch, item)
    assert batch > 1000


def test_same_as_the_bounded_form(spark):
    data = days(5)
    bounds = PacketBounds(max_items=3, item_bytes=32, total_bytes=60)

    def shaped(df):
        return df.select(
            F.date_add(F.lit("2024-01-01").cast("date"), F.col("day")).alias("day"), F.col("id").alias("record_id"),
            F.col("id").alias("captured_at"), "text", F.sha2("text", 256).alias("source_text_sha256"),
        )

    rows = shaped(frame(spark, data))
    columns = ["day", "record_id", "seq", "batch_no", "item_no", "packet_text", "packet_bytes", "packet_text_sha256", "truncated"]
    some = packets.batched_items(rows, bounds, 32).select(*columns)
    every = packets.all_batched_items(rows, bounds, block_rows=1).select(*columns)
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, every.where("batch_no <= 32").collect()))


def test_empty_table(spark):
    none = frame(spark, {1: [("a", "x")]}).where("false")
    assert batching.whole_batches(none, ["day"], ["id"], lambda c: c, 3, 10).count() == 0
    assert next_fit(none, ["day"], ["id"], lambda c: c, 3, 10, 2).count() == 0


def test_texts_are_read_for_chosen_keys_alone(spark, tmp_path):
    """Below the last limit of rows, and in any exchange there, no text is read."""
    frame(spark, days(3)).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    found = budgeted_prefix(stored, ["day"], ["id"], lambda c: truncate_utf8(c, 20), 3, 50)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" not in plan and "BroadcastHashJoin" in plan
    seen = []

    def spied(df, name):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, name)

    from ledgerloom.operators import groups

    real, groups.stored_with_size = groups.stored_with_size, spied
    try:
        chosen_rows(stored, ["day"], ["id"], 3)
    finally:
        groups.stored_with_size = real
    assert len(seen) == 1 and "WindowGroupLimit" in seen[0] and "text#" not in seen[0]


def test_ties_and_many_keys(spark, monkeypatch):
    rows = [(1, "a", str(i)) for i in range(6)] + [(1, "b", "z"), (2, "a", "y"), (None, "c", "n")]
    df = spark.createDataFrame(rows, "day int, id string, text string")

    def kept():
        found = budgeted_prefix(df, ["day"], ["id"], lambda c: c, 4, 100).collect()
        return sorted((r["day"] or 0, r["seq"], r["id"]) for r in found)

    wanted = [(0, 1, "c"), (1, 1, "a"), (1, 2, "a"), (1, 3, "a"), (1, 4, "a"), (2, 1, "a")]
    assert kept() == wanted
    monkeypatch.setattr("ledgerloom.operators.groups.BROADCAST_BYTES", 0)
    assert kept() == wanted
