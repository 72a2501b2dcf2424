from __future__ import annotations

import json

import pytest

from ledgerloom.operators import ledger
from ledgerloom.plans import jobs
from ledgerloom.sources import byte_ranges
from ledgerloom.sources.run_tables import RunTables
from ledgerloom.streaming import log_stream


def event(text: str) -> bytes:
    body = {"timestamp": "2024-07-24T09:00:00Z", "payload": {"type": "message", "role": "user", "content": text}}
    return json.dumps(body).encode() + b"\n"


@pytest.fixture
def place(tmp_path):
    (tmp_path / "logs").mkdir()
    return tmp_path


def streamed(spark, place, checkpoint="checkpoint", **options):
    store = RunTables(spark, str(place / "store"))
    query = log_stream.stream_ledger(spark, str(place / "logs"), store, str(place / checkpoint), **options)
    query.awaitTermination(240)
    if query.exception():
        raise query.exception()
    return texts(spark, place)


def scanned(spark, place):
    jobs.ingest(spark, str(place / "logs"), RunTables(spark, str(place / "store")))
    return texts(spark, place)


def texts(spark, place):
    rows = RunTables(spark, str(place / "store")).read("ledger").collect()
    assert len({r["record_id"] for r in rows}) == len(rows)
    return sorted(r["text"] for r in rows)


def test_appended_lines_are_read_once(spark, place):
    path = place / "logs" / "a.jsonl"
    path.write_bytes(event("one") + event("two")[:-10])
    assert streamed(spark, place) == ["one"]
    path.write_bytes(event("one") + event("two") + event("three"))
    (place / "logs" / ".hidden").mkdir()
    (place / "logs" / ".hidden" / "_b.jsonl").write_bytes(event("four"))
    assert streamed(spark, place) == ["four", "one", "three", "two"]
    assert streamed(spark, place) == ["four", "one", "three", "two"]
    batch = ledger.ledger_records(byte_ranges.scan_lines(spark, str(place / "logs")))
    stored = RunTables(spark, str(place / "store")).read("ledger")
    assert sorted(r["record_id"] for r in batch.collect()) == sorted(r["record_id"] for r in stored.collect())


def test_streams_and_scans_share_a_store(spark, place):
    path = place / "logs" / "a.jsonl"
    data = event("one")
    path.write_bytes(data)
    assert scanned(spark, place) == ["one"]
    data += event("two")
    path.write_bytes(data)
    assert streamed(spark, place) == ["one", "two"]
    assert scanned(spark, place) == ["one", "two"]
    data += event("three")
    path.write_bytes(data)
    assert scanned(spark, place) == ["one", "three", "two"]
    # A new checkpoint reads everything again; the store knows what it has.
    data += event("four")
    path.write_bytes(data)
    assert streamed(spark, place, "other") == ["four", "one", "three", "two"]
    totals = RunTables(spark, str(place / "store")).commits("ingest").select("counters").collect()
    assert sum(r["counters"]["new_records"] for r in totals) == 4


def test_changed_and_missing_sources_stop_a_stream(spark, place):
    path = place / "logs" / "a.jsonl"
    path.write_bytes(event("one"))
    assert streamed(spark, place) == ["one"]
    path.write_bytes(event("oNe") + event("two"))
    with pytest.raises(Exception, match="processed bytes changed"):
        streamed(spark, place)
    path.rename(place / "logs" / "b.jsonl")
    with pytest.raises(Exception, match="unavailable"):
        streamed(spark, place)
    assert texts(spark, place) == ["one"]


def test_rejected_lines_are_kept(spark, place):
    (place / "logs" / "a.jsonl").write_bytes(event("one") + b"{nope}\n")
    assert streamed(spark, place, on_reject="quarantine") == ["one"]
    row = RunTables(spark, str(place / "store")).read("rejected").first()
    assert (row["source"], bytes(row["raw"]).strip(), row["byte_start"]) == ("a.jsonl", b"{nope}", len(event("one")))


def test_ranges_of_a_batch_meet(tmp_path):
    reader = log_stream.LogStreamReader({"path": str(tmp_path), "rangebytes": "10"})
    data = b"".join(b"%d\n" % (10**n) for n in range(12))
    (tmp_path / "x.jsonl").write_bytes(data)
    end = reader.latestOffset()
    parts = reader.partitions({"x.jsonl": 5}, end)
    rows = [row for part in parts for batch in reader.read(part) for row in batch.to_pylist()]
    assert [(r["byte_start"], r["raw"]) for r in rows] == [
        (start, b"%d\n" % (10**n)) for n, start in ((n, sum(k + 2 for k in range(n))) for n in range(12))
        if start + n + 2 > 5
    ]


def test_a_backlog_is_read_in_bounded_batches(spark, place):
    wanted = []
    for name in "abc":
        lines = [f"{name}{n}" for n in range(4)]
        (place / "logs" / f"{name}.jsonl").write_bytes(b"".join(event(text) for text in lines))
        wanted += lines
    store = RunTables(spark, str(place / "store"))
    size = 2 * len(event("a0")) + 5
    batches = log_stream.drain_ledger(spark, str(place / "logs"), store, str(place / "checkpoint"), size)
    assert batches == -(-12 * len(event("a0")) // size) and texts(spark, place) == sorted(wanted)
    offsets = [p.read_text().splitlines()[-1] for p in (place / "checkpoint" / "offsets").glob("[0-9]*")]
    assert all(json.loads(o).keys() == {"admission"} for o in offsets)
    (place / "logs" / "d.jsonl").write_bytes(event("late"))
    assert log_stream.drain_ledger(spark, str(place / "logs"), store, str(place / "checkpoint"), size) == 1
    assert texts(spark, place) == sorted([*wanted, "late"])


def test_admissions_of_lost_batches_are_read_by_the_next(tmp_path, monkeypatch):
    monkeypatch.setattr(log_stream.Admissions, "EVERY", 3)
    (tmp_path / "logs").mkdir()
    data = b"".join(b"%05d\n" % n for n in range(40))
    for name in ("x", "y"):
        (tmp_path / "logs" / f"{name}.jsonl").write_bytes(data)
    options = {"path": str(tmp_path / "logs"), "maxbytes": "50", "rangebytes": "16", "admissions": str(tmp_path / "a")}
    reader = log_stream.LogStreamReader(options)
    place, found = reader.initialOffset(), []
    while True:
        reader.latestOffset()
        # Admitted, but lost before a batch was logged; a new reader goes on.
        reader = log_stream.LogStreamReader(options)
        end = reader.latestOffset()
        if end == place:
            break
        parts = reader.partitions(place, end)
        assert sum(p.end - p.start for p in parts) <= 100
        found += [(r["source"], r["byte_start"]) for p in parts for b in reader.read(p) for r in b.to_pylist()]
        place = end
    assert sorted(found) == [(f"{name}.jsonl", 6 * n) for name in ("x", "y") for n in range(40)]
