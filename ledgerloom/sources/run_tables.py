"""Tables written in numbered runs, of which readers see only the committed ones.

A writer puts a run's rows into folders of its own attempt and commits by putting the
run's commit file in place, which names the attempt. The file is written beside its place and
renamed, which fails if the place is taken. So of two writers on one run one is refused, a commit is
whole or absent, and what a lost or refused writer left is never read. A file that is no commit, as a
writer of an older version could leave, belongs to nobody, and its number is passed over.
The file system's rename must not replace files, as on HDFS and local disks.

Many small runs are merged as in a log-structured tree: ``compact`` merges ``FANOUT`` runs or
merged spans of one level into a span of the next, which keeps every row with its run and is stored by
day. Spans become visible with one commit of their own, so of two writers one is refused.
Files of merged runs stay for readers that listed them before, until ``vacuum`` removes them.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import set_digest
from ledgerloom.sources.byte_ranges import FRONTIER_SCHEMA
from ledgerloom.sources.tables import STORED_LEDGER_SCHEMA

# Table name: (lane whose commits it follows, schema).
TABLES: dict[str, tuple[str, str]] = {
    "ledger": ("ingest", STORED_LEDGER_SCHEMA),
    "rejected": ("ingest", "source string, byte_start bigint, byte_end bigint, reject_reason string, raw binary"),
    "frontier": ("ingest", FRONTIER_SCHEMA),
    "segments": ("ingest", "source string, range_start bigint, range_end bigint, sha256 string"),
    "roots": ("ingest", "source string, ranges bigint, reached bigint, root_sha256 string"),
    "accounted": ("daily", "lane string, day date, id string"),
    "batches": (
        "daily",
        "packet_sha256 string, day date, timezone string, batch_id string, batch_seq bigint, "
        "result_sha256 string, included bigint, omitted bigint, not_yet_admitted bigint",
    ),
    "entries": (
        "daily",
        "packet_sha256 string, day date, batch_id string, entry_no int, entry_id string, "
        "source_record_ids array<string>, summary string",
    ),
    "batch_documents": ("daily", "batch_id string, day date, document string"),
    "batch_commits": (
        "daily",
        "batch_id string, day date, packet_sha256 string, result_sha256 string, "
        "document_sha256 string, plan_sha256 string, commit_sha256 string",
    ),
    "documents": ("documents", "target_key string, body string, sha256 string"),
    "disposed": ("documents", "lane string, day date, id string"),
    "accounted_digests": ("daily", f"lane string, day date, {set_digest.SCHEMA}"),
    "disposed_digests": ("documents", f"lane string, day date, {set_digest.SCHEMA}"),
    "document_digests": ("documents", set_digest.SCHEMA),
    "sweeps": ("documents", "packet_sha256 string, result_sha256s string, results int, result_sha256 string"),
}

#: Units of one level that are merged into one of the next.
FANOUT = 8
_SPANS = "run int, attempt string, spans array<struct<first:int,last:int,level:int,attempt:string>>"


class RunTakenError(RuntimeError):
    """Another writer committed the run first."""


@dataclass(frozen=True)
class Span:
    """Consecutive runs in one place: a run itself at level 0, else merged."""

    first: int
    last: int
    level: int
    attempt: str


def merged_spans(spans: list[Span], fanout: int) -> list[tuple[list[Span], int]]:
    """The spans, in order, in groups that are to be one, with its level: ``fanout`` of a level make one of the next.

    The oldest are merged first, so runs that are left are the newest.
    """
    groups = [([span], span.level) for span in spans]
    while True:
        for at in range(len(groups) - fanout + 1):
            part = groups[at : at + fanout]
            if len({level for _, level in part}) == 1:
                groups[at : at + fanout] = [([s for some, _ in part for s in some], part[0][1] + 1)]
                break
        else:
            return groups


@dataclass(frozen=True)
class RunTables:
    spark: SparkSession
    root: str
    attempt: str = field(default_factory=lambda: uuid.uuid4().hex)

    def _folder(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def _hadoop(self, path: str) -> tuple:
        hadoop_path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path

    def exists(self, path: str) -> bool:
        filesystem, hadoop_path = self._hadoop(path)
        return filesystem.exists(hadoop_path)

    def run_folder(self, name: str, run: int) -> str:
        return f"{self._folder(name)}/run={run}"

    def _attempt_folder(self, name: str, run: int) -> str:
        return f"{self.run_folder(name, run)}/attempt={self.attempt}"

    def commits(self, lane: str) -> DataFrame:
        """(run, attempt, counters) of the committed runs of a lane."""
        schema = "run int, attempt string, counters map<string,bigint>"
        return self._commit_files(lane, schema)

    def _commit_files(self, lane: str, schema: str) -> DataFrame:
        folder = self._folder(f"commits/{lane}")
        if not self.exists(folder):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).json(folder).where("run IS NOT NULL AND attempt IS NOT NULL")

    def last_run(self, lane: str) -> int:
        """Number of the last committed run of a lane, 0 if there is none."""
        return self.commits(lane).agg(F.max("run").alias("run")).first()["run"] or 0

    def next_run(self, lane: str) -> int:
        """The number a writer takes, read before anything its result depends on."""
        run = self.last_run(lane) + 1
        while self.exists(self._commit_file(lane, run)) and self.last_run(lane) < run:
            run += 1
        return run

    def _commit_file(self, lane: str, run: int) -> str:
        return f"{self._folder(f'commits/{lane}')}/run-{run}.json"

    def commit(self, lane: str, run: int, counters: dict[str, int]) -> None:
        """Make this attempt the run; refused if the run is committed already."""
        self._put(lane, run, {"run": run, "attempt": self.attempt, "counters": counters})

    def _put(self, lane: str, run: int, body: dict) -> None:
        """Put a commit file in place, whole and only if the place is free."""
        target = self._commit_file(lane, run)
        filesystem, beside = self._hadoop(f"{self._folder(f'commits/{lane}')}/.run-{run}-{uuid.uuid4().hex}")
        out = filesystem.create(beside, False)
        out.write(bytearray((json.dumps(body) + "\n").encode()))
        out.close()
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        context = hadoop.FileContext.getFileContext(
            filesystem.makeQualified(beside).toUri(), self.spark.sparkContext._jsc.hadoopConfiguration()
        )
        rename = getattr(hadoop, "Options$Rename")
        never_replace = self.spark.sparkContext._gateway.new_array(rename, 1)
        never_replace[0] = rename.NONE
        try:
            context.rename(filesystem.makeQualified(beside), filesystem.makeQualified(self._hadoop(target)[1]), never_replace)
        except Py4JJavaError as error:
            filesystem.delete(beside, False)
            if "FileAlreadyExists" in str(error.java_exception):
                raise RunTakenError(f"run {run} of {lane} is committed already") from None
            raise

    def write(self, name: str, run: int, rows: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        """Write a run's rows, with files sized by what the partitions hold."""
        hinted = rows.hint("rebalance", *partition_by) if partition_by else rows.hint("rebalance")
        hinted.write.mode("overwrite").partitionBy(*partition_by).parquet(self._attempt_folder(name, run))

    def _rows(self, name: str, folder: str) -> DataFrame:
        _, schema = TABLES[name]
        if not self.exists(folder):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(folder)

    def read_run(self, name: str, run: int) -> DataFrame:
        """What this attempt wrote of a run, committed or not."""
        return self._rows(name, self._attempt_folder(name, run))

    def leftovers(self, name: str, run: int) -> DataFrame:
        """What any attempt wrote of a run."""
        return self._rows(name, self.run_folder(name, run))

    def read(self, name: str) -> DataFrame:
        """Rows of all committed runs, with their ``run``."""
        lane, schema = TABLES[name]
        spans = self.spans(lane)
        rows = self._live(name, max((span.last for span in spans), default=0))
        for folder in (self._span_folder(name, span) for span in spans):
            if self.exists(folder):
                rows = rows.unionByName(self.spark.read.schema(f"{schema}, run int").parquet(folder).select(*rows.columns))
        return rows

    def _live(self, name: str, merged: int) -> DataFrame:
        """Rows of the committed runs after ``merged``."""
        lane, schema = TABLES[name]
        if not self.exists(self._folder(name)):
            return self.spark.createDataFrame([], f"{schema}, run int")
        rows = self.spark.read.schema(f"{schema}, run int, attempt string").parquet(self._folder(name))
        committed = self.commits(lane).select("run", "attempt").where(F.col("run") > merged)
        columns = [c for c in rows.columns if c != "attempt"]
        live = rows.where(F.col("run") > merged) if merged else rows
        return live.join(committed, ["run", "attempt"], "left_semi").select(*columns)

    def spans(self, lane: str) -> list[Span]:
        """The merged spans of a lane, in order; their number grows with the logarithm of the runs."""
        if not self.exists(self._folder(f"commits/{lane}-spans")):
            return []
        last = self._commit_files(f"{lane}-spans", _SPANS).orderBy(F.desc("run")).first()
        return [Span(s["first"], s["last"], s["level"], s["attempt"]) for s in last["spans"]] if last else []

    def _span_folder(self, name: str, span: Span) -> str:
        return f"{self._folder(f'{name}-merged')}/span={span.first}-{span.last}-{span.attempt}"

    def compact(self, lane: str, fanout: int = FANOUT) -> list[Span]:
        """Merge runs and spans of a lane as far as ``fanout`` of one level stand in a row; returns the new spans."""
        number = self.next_run(f"{lane}-spans")
        before = self.spans(lane)
        merged = max((span.last for span in before), default=0)
        runs = self.commits(lane).where(F.col("run") > merged).select("run", "attempt").orderBy("run").collect()
        units = before + [Span(r["run"], r["run"], 0, r["attempt"]) for r in runs]
        attempt, made = uuid.uuid4().hex, []
        after = []
        for group, level in merged_spans(units, fanout):
            if len(group) == 1:
                after += [span for span in group if span.level]
                continue
            span = Span(group[0].first, group[-1].last, level, attempt)
            after.append(span)
            made.append(span)
        if not made:
            return []
        for name, (owner, schema) in TABLES.items():
            if owner == lane and self.exists(self._folder(name)):
                for span in made:
                    self._write_span(name, span, schema)
        self._put(f"{lane}-spans", number, {"run": number, "attempt": attempt, "spans": [vars(span) for span in after]})
        return made

    def _write_span(self, name: str, span: Span, schema: str) -> None:
        rows = self.read(name).where(F.col("run").between(span.first, span.last))
        days = [c for c in ("utc_day", "day") if f"{c} date" in schema][:1]
        hinted = rows.hint("rebalance", *days) if days else rows.hint("rebalance")
        hinted.write.mode("overwrite").partitionBy(*days).parquet(self._span_folder(name, span))

    def vacuum(self, lane: str, keep: int = 1) -> int:
        """Remove files of runs and spans that the last ``keep`` + 1 commits of spans no longer read; returns folders."""
        states = self._commit_files(f"{lane}-spans", _SPANS).orderBy(F.desc("run")).limit(keep + 1).collect()
        if len(states) <= keep:
            return 0
        oldest = min(max(s["last"] for s in state["spans"]) for state in states)
        used = {f"span={s['first']}-{s['last']}-{s['attempt']}" for state in states for s in state["spans"]}
        removed = 0
        for name, (owner, _) in TABLES.items():
            if owner != lane:
                continue
            for folder, keeps in (
                (self._folder(name), lambda n: not n.startswith("run=") or int(n[4:]) > oldest),
                (self._folder(f"{name}-merged"), lambda n: n in used),
            ):
                if not self.exists(folder):
                    continue
                filesystem, path = self._hadoop(folder)
                for status in filesystem.listStatus(path):
                    if status.isDirectory() and not keeps(status.getPath().getName()):
                        removed += bool(filesystem.delete(status.getPath(), True))
        return removed

    def offsets(self) -> DataFrame:
        """(source, offset): how far each source was processed by all committed runs."""
        return self.read("frontier").groupBy("source").agg(F.max("consumed").alias("offset"))
