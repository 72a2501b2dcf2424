from __future__ import annotations

import pytest

from ledgerloom.streaming import replay_state


def run(spark, place, refuse=False):
    """One run of what is available; returns everything written so far."""
    rows = spark.readStream.schema("record_id string, content_sha256 string").json(str(place / "in"))
    found = replay_state.replay_status(rows)
    if refuse:
        found = replay_state.refuse_conflicts(found)
    query = (
        found.writeStream.format("parquet")
        .option("path", str(place / "out"))
        .option("checkpointLocation", str(place / "checkpoint"))
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(240)
    if query.exception():
        raise query.exception()
    return sorted((r["record_id"], r["content_sha256"], r["status"]) for r in spark.read.parquet(str(place / "out")).collect())


def add(place, name, rows):
    (place / "in").mkdir(exist_ok=True)
    body = "".join(f'{{"record_id": "{i}", "content_sha256": "{c}"}}\n' for i, c in rows)
    (place / "in" / name).write_text(body)


def test_replays_across_restarts(spark, tmp_path):
    add(tmp_path, "a.json", [("r1", "x"), ("r2", "y"), ("r2", "y"), ("r3", "b"), ("r3", "a")])
    first = [("r1", "x", "new"), ("r2", "y", "duplicate"), ("r2", "y", "new"), ("r3", "a", "new"), ("r3", "b", "conflict")]
    assert run(spark, tmp_path) == first
    add(tmp_path, "b.json", [("r1", "x"), ("r2", "z"), ("r4", "w")])
    assert run(spark, tmp_path) == sorted([*first, ("r1", "x", "duplicate"), ("r2", "z", "conflict"), ("r4", "w", "new")])


def test_a_conflict_stops_the_stream(spark, tmp_path):
    add(tmp_path, "a.json", [("r1", "x")])
    assert run(spark, tmp_path, refuse=True) == [("r1", "x", "new")]
    add(tmp_path, "b.json", [("r1", "y"), ("r2", "z")])
    with pytest.raises(Exception, match="conflicting record r1"):
        run(spark, tmp_path, refuse=True)
