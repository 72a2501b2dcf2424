"""Growing log files as a streaming source of byte-addressed lines.

The built-in file stream reads a file once and misses lines appended later.
Here a stream offset is the length of every file, and a batch holds the lines
whose newline lies in the bytes that were added, so unfinished lines wait for
the batch that brings their newline.

With a byte rate an offset is the number of an admission instead: what each admission lets
in lies in a folder beside the checkpoint, files are let in by name up to the rate, and a
batch reads the admissions between its offsets. So offsets stay small, a backlog is read in
bounded batches, and an admission whose batch was lost is read by the next one.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ledgerloom.plans import jobs
from ledgerloom.sources import byte_ranges
from ledgerloom.sources.run_tables import RunTables

FORMAT = "log_lines"


class LogRange(InputPartition):
    def __init__(self, source: str, path: str, start: int, end: int) -> None:
        self.source, self.path, self.start, self.end = source, path, start, end


class Admissions:
    """Numbered files of what was let in: {source: [start, end]}, and now and then {source: end} of everything."""

    EVERY = 64

    def __init__(self, folder: str) -> None:
        self.filesystem, self.folder = byte_ranges.resolve_uri(folder)
        self.filesystem.create_dir(self.folder, recursive=True)
        self.reached: dict[str, int] = {}
        self.last = 0
        for number in self._numbers():
            if number % self.EVERY == 0:
                self.reached = self._read(f"all-{number}")
            else:
                self.reached |= {source: end for source, (_, end) in self._read(f"new-{number}").items()}
            self.last = number

    def _numbers(self) -> list[int]:
        """The last sum of everything and what came after; only whole files count."""
        names = [i.base_name for i in self.filesystem.get_file_info(fs.FileSelector(self.folder))]
        found = sorted(int(name[4:]) for name in names if name.startswith("new-"))
        sums = [n for n in found if n % self.EVERY == 0 and f"all-{n}" in names]
        return [n for n in found if n >= (sums[-1] if sums else 0)]

    def _read(self, name: str) -> dict:
        with self.filesystem.open_input_stream(f"{self.folder}/{name}") as file:
            return json.loads(file.read())

    def _write(self, name: str, content: dict) -> None:
        beside = f"{self.folder}/.{name}"
        with self.filesystem.open_output_stream(beside) as file:
            file.write(json.dumps(content).encode())
        self.filesystem.move(beside, f"{self.folder}/{name}")

    def admit(self, files: Iterator[tuple[str, int]], most_bytes: int) -> int:
        """Let in new bytes of the files, in order of their names, up to the rate; returns the number of the admission."""
        fresh, left = {}, most_bytes
        for source, length in sorted(files):
            start = self.reached.get(source, 0)
            if length > start and left > 0:
                end = min(length, start + left)
                fresh[source], left = [start, end], left - (end - start)
        if not fresh:
            return self.last
        self.reached |= {source: end for source, (_, end) in fresh.items()}
        number = self.last + 1
        if number % self.EVERY == 0:
            self._write(f"all-{number}", self.reached)
        self._write(f"new-{number}", fresh)
        self.last = number
        return number

    def between(self, start: int, end: int) -> dict[str, list[int]]:
        """What the admissions after ``start`` up to ``end`` let in together."""
        found: dict[str, list[int]] = {}
        for number in range(start + 1, end + 1):
            for source, (low, high) in self._read(f"new-{number}").items():
                found[source] = [found[source][0] if source in found else low, high]
        return found


class LogStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.root = options["path"].rstrip("/")
        self.pattern = options.get("pattern", "*.jsonl")
        self.range_bytes = int(options.get("rangebytes", byte_ranges.RANGE_BYTES))
        self.line_bytes = int(options.get("linebytes", byte_ranges.LINE_BYTES))
        self.most_bytes = int(options.get("maxbytes", 0))
        self.admissions = Admissions(options["admissions"]) if self.most_bytes else None

    def initialOffset(self) -> dict[str, int]:
        return {"admission": 0} if self.admissions else {}

    def latestOffset(self) -> dict[str, int]:
        if self.admissions:
            files = ((name, size) for name, size, _ in byte_ranges.listed_files(self.root, self.pattern, True))
            return {"admission": self.admissions.admit(files, self.most_bytes)}
        return {name: size for name, size, _ in byte_ranges.listed_files(self.root, self.pattern, True)}

    def partitions(self, start: dict[str, int], end: dict[str, int]) -> list[LogRange]:
        ranges = []
        if self.admissions:
            added = self.admissions.between(start["admission"], end["admission"])
        else:
            added = {source: [start.get(source, 0), length] for source, length in end.items()}
        for source, (begin, length) in sorted(added.items()):
            for low in range(begin, length, self.range_bytes):
                high = min(low + self.range_bytes, length)
                ranges.append(LogRange(source, f"{self.root}/{source}", low, high))
        return ranges

    def read(self, partition: LogRange) -> Iterator[pa.RecordBatch]:
        with byte_ranges.open_uri(partition.path) as handle:
            yield from byte_ranges.line_batches(
                handle, partition.source, partition.start, partition.end, self.line_bytes
            )


class LogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return byte_ranges.LINES_SCHEMA

    def streamReader(self, schema: object) -> LogStreamReader:
        return LogStreamReader(dict(self.options))


def read_log_stream(
    spark: SparkSession,
    root: str,
    pattern: str = "*.jsonl",
    line_bytes: int = byte_ranges.LINE_BYTES,
    max_bytes: int = 0,
    admissions: str = "",
) -> DataFrame:
    """Lines appended to the logs under ``root``, as a stream.

    With ``max_bytes`` a trigger lets in that many bytes at most and keeps its admissions in the folder ``admissions``,
    which belongs to one checkpoint.
    """
    spark.dataSource.register(LogSource)
    reader = spark.readStream.format(FORMAT).option("path", root).option("pattern", pattern)
    if max_bytes:
        reader = reader.option("maxbytes", str(max_bytes)).option("admissions", admissions)
    return reader.option("linebytes", str(line_bytes)).load()


def stream_ledger(
    spark: SparkSession,
    root: str,
    store: RunTables,
    checkpoint: str,
    pattern: str = "*.jsonl",
    trigger: dict[str, object] | None = None,
    max_bytes: int = 0,
    **options: object,
) -> object:
    """Start writing the ledger from the logs under ``root``; returns the query.

    Every batch is checked and committed as a run of the store, which keeps offsets, range
    hashes, rejected lines and counters for streams and scans alike. ``options`` are those
    of ``jobs.ingest_batch``; with ``verify_prefix=False`` a scheduled ``jobs.ingest``
    can check processed bytes instead of every batch. With ``max_bytes`` a batch holds that many bytes at
    most; a run of what is available now is one such batch, see ``drain_ledger``.
    """

    def write(batch: DataFrame, _: int) -> None:
        # A writer of its own for each batch, so that a refused one leaves nothing to the next.
        jobs.ingest_batch(RunTables(store.spark, store.root), batch, root, pattern, **options)

    line_bytes = max(options.get("max_event_bytes", 0), byte_ranges.LINE_BYTES)
    lines = read_log_stream(spark, root, pattern, line_bytes, max_bytes, admissions_folder(checkpoint))
    writer = lines.writeStream.foreachBatch(write)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def admissions_folder(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-admissions"


def drain_ledger(
    spark: SparkSession, root: str, store: RunTables, checkpoint: str, max_bytes: int, **options: object
) -> int:
    """Read a backlog in batches of at most ``max_bytes`` until nothing is left; returns their number."""
    batches = 0
    while True:
        before = Admissions(byte_ranges.qualified(spark, admissions_folder(checkpoint))).last
        query = stream_ledger(spark, root, store, checkpoint, max_bytes=max_bytes, **options)
        query.awaitTermination()
        if query.exception():
            raise query.exception()
        after = Admissions(byte_ranges.qualified(spark, admissions_folder(checkpoint))).last
        if after == before:
            return batches
        batches += after - before
