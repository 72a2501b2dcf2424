"""Byte-addressed reading of append-only line files.

Files are listed by Spark, split into byte ranges, and the ranges are spread
over the cluster as rows. A task seeks to its range and emits the lines whose
newline lies inside it, with their exact byte addresses, so a file of any size
is read in parallel and no shuffle or window is needed to number the bytes.
A last line without a newline is never emitted. A line of more bytes than a task may
hold is emitted with its addresses and null bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fnmatch import fnmatchcase
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RANGE_BYTES = 128 * 1024 * 1024
CHUNK_BYTES = 8 * 1024 * 1024
LOOKBACK_BYTES = 64 * 1024
#: Longest line whose bytes are held, unless more is asked for; and the most that a row can carry.
LINE_BYTES = 64 * 1024 * 1024
MOST_LINE_BYTES = (1 << 31) - 1 - 4 * CHUNK_BYTES
NEWLINE = 10

LINES_SCHEMA = "source string, byte_start bigint, byte_end bigint, raw binary"
FRONTIER_SCHEMA = "source string, path string, length bigint, offset bigint, consumed bigint"
RANGES_SCHEMA = "source string, path string, range_start bigint, range_end bigint"
HASHES_SCHEMA = RANGES_SCHEMA + ", sha256 string"


def resolve_uri(uri: str) -> tuple[fs.FileSystem, str]:
    """Filesystem and path of a Hadoop-style path."""
    if "://" not in uri:
        return fs.LocalFileSystem(), uri.removeprefix("file:")
    scheme, rest = uri.split("://", 1)
    if scheme == "file":
        return fs.LocalFileSystem(), unquote(rest)
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    return fs.FileSystem.from_uri(f"{scheme}://{quote(rest)}")


def open_uri(uri: str) -> pa.NativeFile:
    """Open a path for random access."""
    filesystem, path = resolve_uri(uri)
    return filesystem.open_input_file(path)


def last_newline_end(handle: pa.NativeFile, low: int, high: int) -> int:
    """Byte after the last newline in [low, high), or ``low`` if there is none."""
    while high > low:
        start = max(low, high - LOOKBACK_BYTES)
        handle.seek(start)
        found = handle.read(high - start).rfind(b"\n")
        if found >= 0:
            return start + found + 1
        high = start
    return low


def lines_in_range(
    handle: pa.NativeFile, start: int, end: int, line_bytes: int = LINE_BYTES
) -> Iterator[tuple[np.ndarray, pa.Buffer | None]]:
    """Line bounds and bytes of the lines whose newline is in [start, end).

    Yields absolute bounds (n + 1 positions for n lines) with the bytes between
    the first and the last of them. A line that is read over several chunks and is longer
    than ``line_bytes`` comes alone and without bytes.
    """
    line_bytes = min(line_bytes, MOST_LINE_BYTES)
    position = last_newline_end(handle, 0, start)
    pending: list[bytes] = []
    line_start = position
    while position < end:
        handle.seek(position)
        chunk = handle.read(min(CHUNK_BYTES, end - position))
        if not chunk:
            return
        newlines = np.flatnonzero(np.frombuffer(chunk, dtype=np.uint8) == NEWLINE)
        first_end = position + int(newlines[0]) + 1 if newlines.size else position + len(chunk)
        if line_start < position and first_end - line_start > line_bytes:
            pending = []
            if newlines.size:
                yield np.array([line_start, first_end]), None
                chunk, newlines = chunk[first_end - position :], newlines[1:] - (first_end - position)
                line_start = position = first_end
        elif newlines.size == 0:
            pending.append(chunk)
        if newlines.size == 0 and line_start == position:
            pending = [chunk]
        elif newlines.size:
            cut = int(newlines[-1]) + 1
            bounds = np.concatenate(([line_start], position + newlines.astype(np.int64) + 1))
            yield bounds, pa.py_buffer(b"".join([*pending, chunk[:cut]]))
            pending = [chunk[cut:]]
            line_start = position + cut
        position += len(chunk)


def line_batches(
    handle: pa.NativeFile, source: str, start: int, end: int, line_bytes: int = LINE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Arrow batches of the lines of one range; the bytes are not copied per line."""
    for bounds, data in lines_in_range(handle, start, end, line_bytes):
        count = len(bounds) - 1
        if data is None:
            raw = pa.nulls(count, pa.binary())
        else:
            offsets = pa.py_buffer((bounds - bounds[0]).astype(np.int32))
            raw = pa.Array.from_buffers(pa.binary(), count, [None, offsets, data])
        yield pa.record_batch(
            [
                pa.array([source] * count, pa.string()),
                pa.array(bounds[:-1], pa.int64()),
                pa.array(bounds[1:], pa.int64()),
                raw,
            ],
            names=["source", "byte_start", "byte_end", "raw"],
        )


def _line_batches(line_bytes: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open_uri(row["path"]) as handle:
                    yield from line_batches(handle, row["source"], row["range_start"], row["range_end"], line_bytes)

    return apply


def _frontier_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        consumed = []
        for row in batch.to_pylist():
            offset, length = row["offset"], row["length"]
            if offset >= length:
                consumed.append(offset)
                continue
            with open_uri(row["path"]) as handle:
                consumed.append(last_newline_end(handle, offset, length))
        yield batch.append_column("consumed", pa.array(consumed, pa.int64()))


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes = []
        for row in batch.to_pylist():
            state = hashlib.sha256()
            position, end = row["range_start"], row["range_end"]
            with open_uri(row["path"]) as handle:
                handle.seek(position)
                while position < end:
                    chunk = handle.read(min(CHUNK_BYTES, end - position))
                    if not chunk:
                        break
                    state.update(chunk)
                    position += len(chunk)
            hashes.append(state.hexdigest() if position >= end else None)
        yield batch.append_column("sha256", pa.array(hashes, pa.string()))


def qualified(spark: SparkSession, path: str) -> str:
    """Path with scheme and authority, as the file listing shows it."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop_path.getFileSystem(conf).makeQualified(hadoop_path).toString()


def listed_files(uri: str, pattern: str, recursive: bool) -> Iterator[tuple[str, int, bool]]:
    """(path below ``uri``, length, whether it is a folder) of matching files, and of folders unless recursive.

    Every name counts, also hidden ones, and so do empty files.
    """
    filesystem, base = resolve_uri(uri)
    prefix = len(base.rstrip("/")) + 1
    for info in filesystem.get_file_info(fs.FileSelector(base, recursive=recursive)):
        if info.type == fs.FileType.File and fnmatchcase(info.base_name, pattern):
            yield info.path[prefix:], info.size, False
        elif info.type == fs.FileType.Directory and not recursive:
            yield info.path[prefix:], 0, True


def _listed_batches(root: str, pattern: str):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column("folder").to_pylist():
                found = [(f"{folder}/{name}", size) for name, size, _ in listed_files(f"{root}/{folder}", pattern, True)]
                if found:
                    yield pa.record_batch(
                        [
                            pa.array([name for name, _ in found]),
                            pa.array([f"{root}/{name}" for name, _ in found]),
                            pa.array([size for _, size in found], pa.int64()),
                        ],
                        names=["source", "path", "length"],
                    )

    return apply


def list_sources(spark: SparkSession, root: str, pattern: str = "*.jsonl") -> DataFrame:
    """All log files under ``root`` as (source, path, length); contents are not read.

    The folders right below ``root`` are listed by tasks, each with all it holds.
    """
    base = qualified(spark, root).rstrip("/")
    top = list(listed_files(base, pattern, False))
    schema = "source string, path string, length bigint"
    files = spark.createDataFrame([(name, f"{base}/{name}", size) for name, size, folder in top if not folder], schema)
    folders = [(name,) for name, _, folder in top if folder]
    if not folders:
        return files
    tasks = min(len(folders), max(spark.sparkContext.defaultParallelism, 64))
    below = spark.createDataFrame(folders, "folder string").repartition(tasks)
    return files.union(below.mapInArrow(_listed_batches(base, pattern), schema))


def with_frontier(files: DataFrame, offsets: DataFrame | None = None, tasks: int = 64) -> DataFrame:
    """Add the saved ``offset`` and ``consumed``, the end of the last complete line."""
    if offsets is None:
        known = files.withColumn("offset", F.lit(0).cast("bigint"))
    else:
        saved = offsets.select("source", F.col("offset").cast("bigint").alias("offset"))
        known = files.join(saved, "source", "left").withColumn(
            "offset", F.coalesce("offset", F.lit(0).cast("bigint"))
        )
    rows = known.select("source", "path", "length", "offset").repartition(tasks)
    return rows.mapInArrow(_frontier_batches, FRONTIER_SCHEMA)


def byte_ranges(frontier: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Cut the unread part of every file into ranges of bounded size."""
    last = F.col("consumed") - 1
    starts = F.sequence("offset", last, F.lit(range_bytes).cast("bigint"))
    return (
        frontier.where(F.col("consumed") > F.col("offset"))
        .select("source", "path", "consumed", F.explode(starts).alias("range_start"))
        .select(
            "source",
            "path",
            "range_start",
            F.least(F.col("range_start") + range_bytes, F.col("consumed")).alias("range_end"),
        )
    )


def read_lines(ranges: DataFrame, tasks: int, line_bytes: int = LINE_BYTES) -> DataFrame:
    """Lines of the given ranges as (source, byte_start, byte_end, raw); null ``raw`` is a line over ``line_bytes``."""
    return ranges.repartition(tasks).mapInArrow(_line_batches(line_bytes), LINES_SCHEMA)


def hash_ranges(ranges: DataFrame, tasks: int) -> DataFrame:
    """sha256 of every range; null where the file is shorter than the range."""
    rows = ranges.select("source", "path", "range_start", "range_end")
    return rows.repartition(tasks).mapInArrow(_hash_batches, HASHES_SCHEMA)


def task_count(spark: SparkSession, frontier: DataFrame, range_bytes: int = RANGE_BYTES) -> int:
    """Tasks for a scan: about one per range, at least one per core."""
    unread = F.sum(F.greatest(F.col("consumed") - F.col("offset"), F.lit(0)))
    total = frontier.agg(unread.alias("bytes")).first()["bytes"] or 0
    return max(spark.sparkContext.defaultParallelism, -(-total // range_bytes))


def scan_lines(
    spark: SparkSession,
    root: str,
    offsets: DataFrame | None = None,
    pattern: str = "*.jsonl",
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """Complete lines under ``root`` past the saved offsets, with byte addresses."""
    frontier = with_frontier(
        list_sources(spark, root, pattern), offsets, spark.sparkContext.defaultParallelism
    )
    return read_lines(byte_ranges(frontier, range_bytes), task_count(spark, frontier, range_bytes))


def pending_tails(frontier: DataFrame) -> DataFrame:
    """Bytes after the last complete line of every source."""
    return frontier.select(
        "source", "length", "consumed", (F.col("length") - F.col("consumed")).alias("pending_bytes")
    )
