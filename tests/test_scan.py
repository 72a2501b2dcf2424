from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import ledger, range_trees
from ledgerloom.sources import byte_ranges


def split(data: bytes) -> list[tuple[int, int, bytes]]:
    lines, start = [], 0
    for piece in data.split(b"\n")[:-1]:
        end = start + len(piece) + 1
        lines.append((start, end, piece + b"\n"))
        start = end
    return lines


def random_bytes(rng: random.Random, size: int) -> bytes:
    return bytes(rng.choice(b"ab\r\n\x85\xe2\x80\xa8 \xff") for _ in range(size))


@pytest.mark.parametrize("chunk", [1, 3, 1000])
def test_any_cut_gives_every_line_once(tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(byte_ranges, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(byte_ranges, "LOOKBACK_BYTES", 2)
    rng = random.Random(chunk)
    for number in range(40):
        data = random_bytes(rng, rng.randrange(0, 120))
        path = tmp_path / f"{number}.jsonl"
        path.write_bytes(data)
        cuts = sorted({0, len(data), *(rng.randrange(len(data) + 1) for _ in range(4))})
        found = []
        with byte_ranges.open_uri(str(path)) as handle:
            for low, high in zip(cuts, cuts[1:], strict=False):
                for batch in byte_ranges.line_batches(handle, "s", low, high):
                    found += [(r["byte_start"], r["byte_end"], r["raw"]) for r in batch.to_pylist()]
            tail = byte_ranges.last_newline_end(handle, 0, len(data))
        assert found == split(data)
        assert tail == (split(data)[-1][1] if split(data) else 0)


@pytest.mark.parametrize("chunk", [1, 3, 1000])
def test_lines_over_the_bound_have_no_bytes(tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(byte_ranges, "CHUNK_BYTES", chunk)
    rng = random.Random(chunk)
    for number in range(40):
        data = random_bytes(rng, rng.randrange(0, 120))
        path = tmp_path / f"{number}.jsonl"
        path.write_bytes(data)
        cuts = sorted({0, len(data), *(rng.randrange(len(data) + 1) for _ in range(3))})
        found = []
        with byte_ranges.open_uri(str(path)) as handle:
            for low, high in zip(cuts, cuts[1:], strict=False):
                for batch in byte_ranges.line_batches(handle, "s", low, high, 7):
                    found += [(r["byte_start"], r["byte_end"], r["raw"]) for r in batch.to_pylist()]
        assert [row[:2] for row in found] == [row[:2] for row in split(data)]
        for (low, high, raw), (_, _, whole) in zip(found, split(data), strict=True):
            assert raw == whole or (raw is None and high - low > 7)
            # Only what came within one chunk may be longer.
            assert raw is None or len(raw) <= max(7, chunk)


def test_a_line_without_bytes_is_rejected(spark):
    rows = [("a", 0, 9, None), ("a", 9, 10, bytearray(b"\n"))]
    lines = spark.createDataFrame(rows, byte_ranges.LINES_SCHEMA)
    bad = ledger.parsed_events(lines, on_reject="quarantine").collect()
    assert [(r["byte_start"], r["byte_end"], r["reject_reason"]) for r in bad] == [(0, 9, "oversize")]


def write(root, name: str, data: bytes) -> None:
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)


def scanned(df) -> list[tuple]:
    return sorted((r["source"], r["byte_start"], r["byte_end"], bytes(r["raw"])) for r in df.collect())


def test_scan_resume_and_tails(spark, tmp_path):
    rng = random.Random(5)
    files = {"a.jsonl": random_bytes(rng, 3000), "sub/b c%20.jsonl": random_bytes(rng, 500), "e.jsonl": b"", "open.jsonl": b"no end"}
    files |= {"_y.jsonl": b"y\n", ".z.jsonl": b"z\n", ".hid/_w/w.jsonl": b"w\n"}
    for name, data in files.items():
        write(tmp_path, name, data)
    write(tmp_path, "other.txt", b"x\n")
    wanted = sorted((name, *line) for name, data in files.items() for line in split(data))
    assert scanned(byte_ranges.scan_lines(spark, str(tmp_path), range_bytes=97)) == wanted
    offsets = spark.createDataFrame([(n, split(d)[2][1]) for n, d in files.items() if len(d) > 100], "source string, offset long")
    rest = scanned(byte_ranges.scan_lines(spark, str(tmp_path), offsets, range_bytes=97))
    limits = {r["source"]: r["offset"] for r in offsets.collect()}
    assert rest == [row for row in wanted if row[1] >= limits.get(row[0], 0)]
    frontier = byte_ranges.with_frontier(byte_ranges.list_sources(spark, str(tmp_path)))
    pending = {r["source"]: r["pending_bytes"] for r in byte_ranges.pending_tails(frontier).collect()}
    assert pending == {n: len(d) - (split(d)[-1][1] if split(d) else 0) for n, d in files.items()}


def test_range_hashes_and_mutation(spark, tmp_path):
    data = bytes(range(256)) * 10
    write(tmp_path, "a.jsonl", data + b"\n")
    files = byte_ranges.list_sources(spark, str(tmp_path))
    ranges = byte_ranges.byte_ranges(byte_ranges.with_frontier(files), 1000)
    ranges = spark.createDataFrame(ranges.collect(), ranges.schema)
    saved = byte_ranges.hash_ranges(ranges, 2).drop("path")
    rows = [tuple(r) for r in saved.collect()]
    for _, low, high, sha in rows:
        assert sha == hashlib.sha256((data + b"\n")[low:high]).hexdigest()
    frozen = spark.createDataFrame(rows, saved.schema)
    write(tmp_path, "a.jsonl", data[:1500] + b"!" + data[1501:] + b"\nmore\n")
    changed = ledger.prefix_violations(frozen, byte_ranges.hash_ranges(ranges, 2))
    assert [(r["range_start"], r["range_end"]) for r in changed.collect()] == [(1000, 2000)]
    write(tmp_path, "a.jsonl", data[:1200])
    cut = ledger.prefix_violations(frozen, byte_ranges.hash_ranges(ranges, 2)).orderBy("range_start")
    assert [r["range_start"] for r in cut.collect()] == [1000, 2000]


def test_missing_sources(spark):
    saved = spark.createDataFrame([("a",), ("b",)], "source string")
    files = spark.createDataFrame([("b",), ("c",)], "source string")
    assert [r["source"] for r in ledger.missing_sources(saved, files).select(F.col("source")).collect()] == ["a"]


def plain_root(ranges):
    nodes = {low: hashlib.sha256(f"{low}:{high}:{sha}".encode()).hexdigest() for low, high, sha in ranges}
    for level in range(1, 5):
        cells: dict[int, list] = {}
        for node in sorted(nodes):
            cells.setdefault(node >> 16 if level < 4 else 0, []).append(f"{node}:{nodes[node]}")
        nodes = {cell: hashlib.sha256(",".join(found).encode()).hexdigest() for cell, found in cells.items()}
    return nodes.get(0)


def test_trees_find_the_edited_range(spark):
    rng = random.Random(8)
    files = {}
    for name in ("a", "b", "c"):
        cuts = sorted({0, *(rng.choice([rng.randrange(1 << 18), rng.randrange(1 << 40)]) for _ in range(30))})
        files[name] = [(low, high, f"{rng.getrandbits(64):064x}") for low, high in zip(cuts, cuts[1:], strict=False)]

    def frame(some):
        return spark.createDataFrame([(n, *r) for n, rows in some.items() for r in rows], "source string, range_start long, range_end long, sha256 string")

    before = frame(files)
    roots = {r["source"]: (r["ranges"], r["reached"], r["root_sha256"]) for r in range_trees.roots(before).collect()}
    assert roots == {n: (len(rows), rows[-1][1], plain_root(rows)) for n, rows in files.items()}
    edited = {n: list(rows) for n, rows in files.items()}
    low, high, _ = edited["b"][7]
    edited["b"][7] = (low, high, "f" * 64)
    assert [r["source"] for r in range_trees.differing_roots(range_trees.roots(before), range_trees.roots(frame(edited))).collect()] == ["b"]
    nodes = range_trees.differing_nodes(range_trees.tree(before), range_trees.tree(frame(edited))).collect()
    assert {(r["source"], r["level"], r["node"]) for r in nodes} == {("b", k, low >> 16 * k if k < 4 else 0) for k in range(5)}


def test_every_range_is_due_once_in_a_period(spark):
    rows = [("s%d" % (n % 7), n * 1000) for n in range(300)]
    ranges = spark.createDataFrame(rows, "source string, range_start long")
    found = [tuple(r) for run in range(11, 16) for r in range_trees.due(ranges, run, 5).collect()]
    assert sorted(found) == sorted(rows)
    assert range_trees.due(ranges, 3, 1).count() == 300
