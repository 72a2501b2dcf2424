"""The three jobs end to end: ingest logs, apply daily decisions, apply document decisions.

Each job reads committed runs, checks everything before it writes, writes its
tables under the next run number and commits that number last.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.bounds import (
    MAX_BATCHES_PER_RUN,
    MAX_EVENT_BYTES,
    MAX_MESSAGE_CHARS,
    DigestBounds,
    PacketBounds,
)
from ledgerloom.functions import ident, routes, set_digest
from ledgerloom.operators import apply, daily, decisions, documents, ledger, packets, range_trees
from ledgerloom.session import configure
from ledgerloom.sources import byte_ranges, run_tables, tables
from ledgerloom.sources.run_tables import RunTables


class LedgerError(RuntimeError):
    """A check failed; nothing was committed."""


class SourceMutationError(LedgerError):
    """Bytes that were processed before have changed."""


@dataclass(frozen=True)
class IngestResult:
    new_records: int
    duplicate_records: int
    sources_checked: int
    pending_bytes: int
    unsupported_events: int
    rejected_events: int
    unsupported_total: int


def _require_none(rows: DataFrame, message: str, error: type[LedgerError] = LedgerError) -> None:
    """Fail with one example if there is any row."""
    example = rows.limit(1).collect()
    if example:
        raise error(f"{message}: {example[0].asDict()}")


def ingest(
    spark: SparkSession,
    source_root: str,
    store: RunTables,
    pattern: str = "*.jsonl",
    max_chars: int = MAX_MESSAGE_CHARS,
    max_event_bytes: int = MAX_EVENT_BYTES,
    on_reject: str = "fail",
    replay: bool = False,
    verify_prefix: bool = True,
    range_bytes: int = byte_ranges.RANGE_BYTES,
    verify_period: int = 1,
) -> IngestResult:
    """Add the messages in new complete lines of the logs to the ledger.

    Offsets and ledger rows become visible with one commit, so rows past a saved
    offset cannot be in the ledger and no join with it is needed. ``replay``
    reads all logs from the start and compares with the ledger, for a store
    whose offsets are not to be trusted.

    Processed bytes are hashed again by ranges, all of them or, with a ``verify_period`` of n, those whose turn
    it is, so that n runs check everything. The stored hashes are held against each file's
    root in every run, which reads no log.
    """
    configure(spark)
    run = store.next_run("ingest")
    files = byte_ranges.list_sources(spark, source_root, pattern)
    saved = store.offsets()
    _check_sources(spark, store, files, saved, verify_prefix, run, verify_period)
    # Logs may grow while the job runs, so how far it reads is written down first.
    cores = spark.sparkContext.defaultParallelism
    store.write("frontier", run, byte_ranges.with_frontier(files, saved, cores))
    frontier = store.read_run("frontier", run)
    unread = frontier.withColumn("offset", F.lit(0).cast("bigint")) if replay else frontier
    tasks = byte_ranges.task_count(spark, unread, range_bytes)
    line_bytes = max(max_event_bytes, byte_ranges.LINE_BYTES)
    lines = byte_ranges.read_lines(byte_ranges.byte_ranges(unread, range_bytes), tasks, line_bytes)
    return _write_run(store, run, lines, frontier, tasks, range_bytes, max_chars, max_event_bytes, on_reject, replay)


def ingest_batch(
    store: RunTables,
    lines: DataFrame,
    source_root: str,
    pattern: str = "*.jsonl",
    max_chars: int = MAX_MESSAGE_CHARS,
    max_event_bytes: int = MAX_EVENT_BYTES,
    on_reject: str = "fail",
    verify_prefix: bool = True,
    range_bytes: int = byte_ranges.RANGE_BYTES,
    verify_period: int = 1,
) -> IngestResult | None:
    """Add a stream's batch of complete lines to the ledger; None if the store has them all.

    The store's offsets decide which lines are new, so a batch that is run again, a new
    stream on an old store, and a scan between two batches neither lose nor repeat a
    line. A batch that begins past a source's offset is refused.
    """
    spark = configure(store.spark)
    run = store.next_run("ingest")
    files = byte_ranges.list_sources(spark, source_root, pattern)
    saved = store.offsets()
    _check_sources(spark, store, files, saved, verify_prefix, run, verify_period)
    zero = F.lit(0).cast("bigint")
    known = lines.join(saved, "source", "left").withColumn("offset", F.coalesce("offset", zero))
    fresh = known.where(F.col("byte_start") >= F.col("offset"))
    reached = fresh.groupBy("source").agg(
        F.first("offset").alias("offset"), F.min("byte_start").alias("begin"), F.max("byte_end").alias("consumed")
    )
    columns = ["source", "path", "length", "offset", "consumed"]
    store.write("frontier", run, files.join(reached, "source").where("begin = offset").select(*columns))
    frontier = store.read_run("frontier", run)
    _require_none(
        reached.join(frontier.select("source"), "source", "left_anti").select("source", "offset", "begin"),
        "a stream begins past what the store holds",
    )
    if not frontier.limit(1).count():
        return None
    tasks = byte_ranges.task_count(spark, frontier, range_bytes)
    return _write_run(
        store, run, fresh.drop("offset"), frontier, tasks, range_bytes, max_chars, max_event_bytes, on_reject
    )


def _check_sources(
    spark: SparkSession,
    store: RunTables,
    files: DataFrame,
    saved: DataFrame,
    verify_prefix: bool,
    run: int,
    verify_period: int,
) -> None:
    _require_none(ledger.missing_sources(saved, files), "a tracked source is unavailable")
    if verify_prefix:
        _verify_prefix(spark, store, files, run, verify_period)


def _write_run(
    store: RunTables,
    run: int,
    lines: DataFrame,
    frontier: DataFrame,
    tasks: int,
    range_bytes: int,
    max_chars: int,
    max_event_bytes: int,
    on_reject: str,
    replay: bool = False,
) -> IngestResult:
    """Write and commit the ledger rows, rejected lines and range hashes of one run."""
    parsed = ledger.parsed_events(lines, max_event_bytes, on_reject)
    rejected = 0
    if on_reject == "quarantine":
        # Their bytes are kept: the offset passes them and they are read only once.
        bad = parsed.where("reject_reason IS NOT NULL")
        store.write("rejected", run, bad.select("source", "byte_start", "byte_end", "reject_reason", "raw"))
        rejected = store.read_run("rejected", run).count()
        parsed = parsed.where("reject_reason IS NULL")
    found = ledger.messages(parsed, max_chars)
    seen = Observation("ingest")
    counters = [
        F.count_if(~F.col("supported")).alias("unsupported"),
        F.count_if(F.col("supported")).alias("supported"),
    ]
    counted = found.observe(seen, *counters)
    records = ledger.with_identity(counted.where("supported"))
    if replay:
        known = store.read("ledger")
        records = ledger.classify_candidates(records, known)
        conflict = F.concat(F.lit("conflicting record "), "record_id")
        is_new = F.when(F.col("status") == "conflict", F.raise_error(conflict).cast("boolean"))
        records = records.where(is_new.otherwise(F.col("status") == "new")).drop("status", "content_sha256")
    leftover = store.leftovers("ledger", run)
    if leftover.limit(1).count():
        # A run that was not committed left rows; they must be what is written again.
        _require_none(
            ledger.unproven_tail(leftover, records), "rows beyond the last commit are not exact replays"
        )
    store.write("ledger", run, tables.with_instant(records), ("utc_day",))
    written = store.read_run("ledger", run).count()
    fresh = byte_ranges.byte_ranges(frontier, range_bytes)
    store.write("segments", run, byte_ranges.hash_ranges(fresh, tasks).drop("path"))
    added = store.read_run("segments", run)
    # Only the trees of files that grew are built again, from hashes.
    grown = store.read("segments").drop("run").join(added.select("source").distinct(), "source", "left_semi")
    store.write("roots", run, range_trees.roots(grown.unionByName(added)))
    sources = frontier.agg(
        F.count("*").alias("sources"), F.sum(F.col("length") - F.col("consumed")).alias("pending")
    ).first()
    # A plan whose result turns out empty is cut short and observes nothing.
    counts = seen.get if written else found.agg(*counters).first()
    before = store.commits("ingest").agg(F.sum(F.col("counters")["unsupported_events"])).first()[0] or 0
    result = IngestResult(
        written,
        counts["supported"] - written,
        sources["sources"],
        sources["pending"] or 0,
        counts["unsupported"],
        rejected,
        before + counts["unsupported"],
    )
    store.commit("ingest", run, vars(result))
    return result


def _latest_roots(store: RunTables) -> DataFrame:
    return store.read("roots").groupBy("source").agg(F.max_by("root_sha256", "run").alias("root_sha256"))


def _verify_prefix(spark: SparkSession, store: RunTables, files: DataFrame, run: int, period: int) -> None:
    segments = store.read("segments").drop("run")
    roots = _latest_roots(store)
    bound = segments.join(roots.select("source"), "source", "left_semi")
    _require_none(
        range_trees.differing_roots(roots, range_trees.roots(bound)), "stored hashes changed", SourceMutationError
    )
    saved = range_trees.due(segments, run, period)
    ranges = saved.join(files.select("source", "path"), "source")
    current = byte_ranges.hash_ranges(ranges, max(spark.sparkContext.defaultParallelism, 64))
    _require_none(
        ledger.prefix_violations(saved, current), "processed bytes changed", SourceMutationError
    )


def write_daily_digests(
    store: RunTables,
    folder: str,
    zone: str = "UTC",
    bounds: DigestBounds | None = None,
    days: DataFrame | None = None,
) -> None:
    """Render the digests of the given days, or of all days, over the committed ledger."""
    records = daily.with_local_day(store.read("ledger"), zone)
    if days is not None:
        records = records.join(days.select("day").distinct(), "day", "left_semi")
    daily.write_digests(daily.digest_documents(records, zone, bounds, days), folder)


def refresh_digests(
    store: RunTables, folder: str, zone: str = "UTC", bounds: DigestBounds | None = None
) -> list[str]:
    """Render again the digests of the days that runs since the last refresh added records to; returns the days.

    How far the ledger was rendered is committed after the digests are written, so a refresh that is lost
    is done again, and a late record renders its day alone.
    """
    run = store.next_run("digests")
    rendered = store.commits("digests").agg(F.max(F.col("counters")["ledger_run"])).first()[0] or 0
    last = store.last_run("ingest")
    records = daily.with_local_day(store.read("ledger").where(F.col("run") <= last), zone)
    # Calendar days, so their number is bounded by the time the logs cover.
    days = [row["day"] for row in daily.changed_days(records, rendered).select("day").orderBy("day").collect()]
    if days:
        chosen = store.spark.createDataFrame([(day,) for day in days], "day date")
        near = records.where(F.col("utc_day").between(days[0] - timedelta(days=1), days[-1] + timedelta(days=1)))
        of_days = near.join(F.broadcast(chosen), "day", "left_semi")
        daily.write_digests(daily.digest_documents(of_days, zone, bounds, chosen), folder)
    if last > rendered:
        store.commit("digests", run, {"ledger_run": last, "days": len(days)})
    return [str(day) for day in days]


def archive_digests(
    spark: SparkSession, digests: str, archive: str, today: str, keep_days: int, apply_copy: bool = False
) -> DataFrame:
    """Days to archive; with ``apply_copy`` their digests are copied, none is deleted.

    A day that is already archived must be identical.
    """

    def read(path: str) -> DataFrame:
        rows = spark.read.text(path, wholetext=True)
        text = F.regexp_replace("value", r"\n\z", "")
        return rows.select(F.col("day").cast("date").alias("day"), text.alias("document"))

    due = daily.archive_candidates(read(digests), F.lit(today).cast("date"), keep_days)
    if not apply_copy:
        return due.select("day", "year", "month")
    store = RunTables(spark, archive)
    stored = read(archive) if store.exists(archive) else due.select("day", "document").where("false")
    hashed = due.withColumn("sha256", F.sha2("document", 256))
    status = apply.write_once(hashed, stored.select("day", F.sha2("document", 256).alias("sha256")), "day", "sha256")
    _require_none(status.where("status = 'conflict'").select("day"), "an archived day differs")
    (
        status.where("status = 'new'")
        .select("year", "month", "day", F.col("document").alias("value"))
        .write.mode("append")
        .partitionBy("year", "month", "day")
        .text(archive)
    )
    copied = read(archive).select("day", F.sha2("document", 256).alias("sha256")) if store.exists(archive) else stored
    lost = apply.write_once(hashed, copied, "day", "sha256").where("status <> 'identical'")
    _require_none(lost.select("day", "status"), "an archived copy is not what was archived")
    return due.select("day", "year", "month")


def prepare_daily_packets(
    store: RunTables, zone: str = "UTC", bounds: PacketBounds | None = None, day: str | None = None
) -> DataFrame:
    """The next packet of every day, or of one day, that has unaccounted records."""
    rows = store.read("ledger")
    dated = daily.with_local_day(rows, zone) if day is None else daily.select_day(rows, day, zone)
    records = dated.select(
        "day", "record_id", "captured_at", "role", "text", F.col("text_sha256").alias("source_text_sha256")
    )
    accounted, applied, digests = store.read("accounted").where(F.col("lane") == "daily"), _applied(store), _digests(store)
    if day is not None:
        of_day = F.col("day") == F.lit(str(day)).cast("date")
        accounted, applied, digests = (rows.where(of_day) for rows in (accounted, applied, digests))
    available = packets.pending(records, accounted)
    items = packets.packet_items(available, bounds, records=records)
    cursors = packets.cursors_of_digests(digests, applied, zone)
    version = f"ledger-run-{store.last_run('ingest')}"
    return packets.build_packets(items, available, cursors, packets.DAILY_STAGE, version, zone, bounds)


def prepare_daily_batches(
    store: RunTables,
    zone: str = "UTC",
    bounds: PacketBounds | None = None,
    max_batches: int | None = MAX_BATCHES_PER_RUN,
) -> DataFrame:
    """Items of the next ``max_batches`` packets of every day, or of all of them with None, as one table."""
    configure(store.spark)
    records = daily.with_local_day(store.read("ledger"), zone).select(
        "day", "record_id", "captured_at", "role", "text", F.col("text_sha256").alias("source_text_sha256")
    )
    accounted = store.read("accounted").where(F.col("lane") == "daily")
    available = packets.pending(records, accounted)
    if max_batches is None:
        return packets.all_batched_items(available, bounds, records=records)
    return packets.batched_items(available, bounds, max_batches, records=records)


def _ledger_near(store: RunTables, prepared: DataFrame) -> DataFrame:
    """The ledger's partitions that can hold records of the packets' local days."""
    low, high = prepared.agg(F.min("day"), F.max("day")).first()
    if low is None:
        return store.read("ledger").where("false")
    return store.read("ledger").where(
        F.col("utc_day").between(low - timedelta(days=1), high + timedelta(days=1))
    )


def _digests(store: RunTables, ids: str = "accounted") -> DataFrame:
    """Stored sums (lane, day, members, lanes) of a table's ids, and those of runs that stored none."""
    lane = run_tables.TABLES[ids][0]
    parts = store.read(f"{ids}_digests")
    older = store.commits(lane).select("run").join(parts.select("run").distinct(), "run", "left_anti")
    runs = [row["run"] for row in older.collect()]
    if not runs:
        return parts.drop("run")
    unsummed = store.read(ids).where(F.col("run").isin(runs))
    return parts.drop("run").unionByName(set_digest.summed(unsummed, ["lane", "day"], F.col("id")))


def _applied(store: RunTables) -> DataFrame:
    return store.read("batches").select(F.lit("daily").alias("lane"), "day", "batch_seq", "batch_id")


def apply_daily(
    store: RunTables,
    prepared: DataFrame,
    entries: DataFrame,
    omitted: DataFrame,
    zone: str = "UTC",
    *,
    producers: DataFrame,
) -> int:
    """Check decisions against their packets and apply them; returns batches applied.

    Packets whose batch is in place are skipped, so applying twice changes
    nothing. ``prepared`` must be stored packets: they are read several times.
    ``producers`` names who made each packet's decisions.
    """
    run = store.next_run("daily")
    items = packets.exploded_items(prepared).withColumnRenamed("record_id", "item_id")
    _require_none(decisions.validate_daily(items, entries, omitted, producers), "daily decisions are invalid")
    rebound = items.withColumnRenamed("item_id", "record_id")
    _require_none(
        packets.rebind_failures(rebound, _ledger_near(store, prepared)), "the ledger no longer holds an item"
    )
    batches = apply.daily_batches(prepared, entries, omitted)
    todo = apply.unapplied(batches, store.read("batches"))
    cursors = packets.cursors_of_digests(_digests(store), _applied(store), zone)
    _require_none(
        packets.stale_packets(todo, cursors).select("packet_sha256", "day"),
        "a packet is stale against the current cursor",
    )
    numbered = todo.withColumn("batch_seq", F.lit(run).cast("bigint"))
    columns = [
        "packet_sha256", "day", "timezone", "batch_id", "batch_seq", "result_sha256",
        "included", "omitted", "not_yet_admitted",
    ]
    store.write("batches", run, numbered.select(*columns))
    written = store.read_run("batches", run)
    applied = written.count()
    if not applied:
        return 0
    identified = apply.daily_entries(written, entries)
    store.write(
        "entries",
        run,
        identified.select("packet_sha256", "day", "batch_id", "entry_no", "entry_id", "source_record_ids", "summary"),
    )
    store.write("batch_documents", run, apply.batch_documents(written, store.read_run("entries", run)))
    store.write("batch_commits", run, apply.commit_rows(written, store.read_run("batch_documents", run)))
    admitted = items.join(written.select("packet_sha256"), "packet_sha256", "left_semi").select(
        F.lit("daily").alias("lane"), "day", F.col("item_id").alias("id")
    )
    store.write("accounted", run, admitted.distinct())
    sums = set_digest.summed(store.read_run("accounted", run), ["lane", "day"], F.col("id"))
    store.write("accounted_digests", run, sums)
    store.commit("daily", run, {"batches": applied})
    return applied


def _undisposed_entries(store: RunTables) -> DataFrame:
    """Committed entries that no sweep disposed of yet."""
    entries = apply.entries_with_results(store.read("entries").drop("run"), store.read("batches")).select(
        "day",
        "batch_id",
        "entry_no",
        "entry_id",
        F.col("result_sha256").alias("daily_result_sha256"),
        F.col("summary").alias("text"),
        ident.sha256_hex(F.col("summary")).alias("source_text_sha256"),
    )
    return packets.pending(entries, store.read("disposed"), "entry_id")


SWEEP_ORDER = ("batch_id", "entry_no")


def prepare_sweep_items(store: RunTables, bounds: PacketBounds | None = None) -> DataFrame:
    """Items of the next sweep of every day, in batch order, then by position."""
    return packets.packet_items(_undisposed_entries(store), bounds, SWEEP_ORDER)


def _verify_commits(store: RunTables) -> None:
    """Fail if a stored batch or its document is not what its commit binds."""
    fresh = apply.commit_rows(store.read("batches"), store.read("batch_documents"))
    outcomes = apply.verify_commits(store.read("batch_commits"), fresh)
    _require_none(outcomes.where("outcome <> 'ok'").select("batch_id", "day", "outcome"), "a commit does not hold")


def prepare_sweep_packets(
    store: RunTables, zone: str = "UTC", bounds: PacketBounds | None = None
) -> DataFrame:
    """The next sweep's packet of every day, bound to the day's commits and the cursor."""
    available = _undisposed_entries(store)
    items = packets.packet_items(available, bounds, SWEEP_ORDER)
    no_batches = _applied(store).where("false")
    cursors = packets.cursors_of_digests(_digests(store, "disposed"), no_batches, zone)
    _verify_commits(store)
    version = apply.commit_digests(store.read("batch_commits"))
    fields = ("entry_id", "daily_result_sha256", "source_text_sha256", "packet_text_sha256", "truncated")
    return packets.build_packets(
        items, available, cursors, packets.DOCUMENT_STAGE, version, zone, bounds, fields
    )


def current_documents(store: RunTables) -> DataFrame:
    """The latest version of every document.

    A run stores only the documents it wrote. Bodies are read only where they
    are used; checks need just keys and hashes.
    """
    return _latest(store.read("documents"))


def current_snapshot(store: RunTables) -> str:
    """Set digest of all current documents, from what each run changed."""
    parts = store.read("document_digests")
    older = store.commits("documents").select("run").join(parts.select("run").distinct(), "run", "left_anti")
    before = older.agg(F.max("run")).first()[0] or 0
    sums = parts.where(F.col("run") > before).drop("run")
    if before:
        # These runs stored no sums, so the documents as of them are summed.
        latest = _latest(store.read("documents").where(F.col("run") <= before))
        member = documents.document_member(F.col("target_key"), F.col("sha256"))
        sums = sums.unionByName(set_digest.summed(latest, [], member))
    return documents.snapshot_digest(sums).first()["snapshot_sha256"]


def _latest(versions: DataFrame) -> DataFrame:
    return versions.groupBy("target_key").agg(
        F.max_by("body", "run").alias("body"), F.max_by("sha256", "run").alias("sha256")
    )


def maintain(store: RunTables) -> dict[str, int]:
    """Merge small runs of every lane; returns how many spans each lane got."""
    return {lane: len(store.compact(lane)) for lane in ("ingest", "daily", "documents")}


def apply_documents(
    store: RunTables,
    prepared: DataFrame,
    context: DataFrame,
    changes: DataFrame,
    dispositions: DataFrame,
    frozen_snapshot_sha256: str,
    zone: str = "UTC",
    *,
    producers: DataFrame,
) -> int:
    """Check document decisions and write the documents they create or replace.

    ``prepared`` are stored packets of ``prepare_sweep_packets``. The job is refused if
    the day's commits, the cursor or any document changed since they were frozen, if a
    create meets a stored document or a replace another content than it expects, if a context row
    is no stored document, if a document would be left without its parent, or if two keys would differ in case alone. Decisions that are in place already
    change nothing; other decisions for the same packet are refused. ``producers`` names who
    made each packet's decisions. The frozen snapshot is that of ``current_snapshot``, or
    ``documents.snapshot_hash`` of all documents, which costs a pass over their keys. Returns the run.
    """
    run = store.next_run("documents")
    items = packets.exploded_items(prepared).withColumnRenamed("entry_id", "item_id")
    results = apply.sweep_results(prepared, changes, dispositions)
    known = store.read("sweeps").select("packet_sha256", F.col("result_sha256").alias("stored_sha256"))
    met = results.join(known, "packet_sha256")
    _require_none(met.where("result_sha256 <> stored_sha256"), "a packet has other decisions in place")
    if not results.join(known, "packet_sha256", "left_anti").limit(1).count():
        return store.last_run("documents")
    _require_none(met, "some packets are in place already; apply the others alone")
    _require_none(
        decisions.validate_structured(items, context, changes, dispositions, producers),
        "document decisions are invalid",
    )
    version = apply.commit_digests(store.read("batch_commits")).withColumnRenamed("source_version", "now")
    moved = prepared.join(version, "day", "left").where(~F.col("source_version").eqNullSafe(F.col("now")))
    _require_none(moved.select("packet_sha256", "day"), "the day's commits changed after the packet was frozen")
    cursors = packets.cursors_of_digests(_digests(store, "disposed"), _applied(store).where("false"), zone)
    _require_none(
        packets.stale_packets(prepared, cursors).select("packet_sha256", "day"),
        "a packet is stale against the current cursor",
    )
    current = current_documents(store)
    if frozen_snapshot_sha256 != current_snapshot(store):
        if frozen_snapshot_sha256 != documents.snapshot_hash(current).first()["snapshot_sha256"]:
            raise LedgerError("documents changed after the snapshot was frozen")
    stored = current.select("target_key", F.col("sha256").alias("document_sha256"))
    _require_none(
        context.select("target_key", "document_sha256").join(stored, ["target_key", "document_sha256"], "left_anti"),
        "a context row is not a stored document",
    )
    keyed = changes.select(
        routes.target_key(F.col("target")).alias("target_key"), "action", "expected_sha256", "body"
    )
    _require_none(ledger.duplicate_ids(keyed, "target_key"), "two packets change one document")
    _require_none(documents.wrong_preimages(current, keyed), "a stored document is not the expected preimage")
    _require_none(documents.orphans(current, keyed.select("target_key", "body")), "a document has no parent")
    _require_none(
        documents.casefold_collisions(current.select("target_key").union(keyed.select("target_key")), "target_key"),
        "two keys differ in case alone",
    )
    store.write("documents", run, keyed.select("target_key", "body", ident.sha256_hex(F.col("body")).alias("sha256")))
    store.write("document_digests", run, documents.snapshot_change(current, store.read_run("documents", run)))
    disposed = items.select(F.lit("documents").alias("lane"), "day", F.col("item_id").alias("id"))
    store.write("disposed", run, disposed.distinct())
    sums = set_digest.summed(store.read_run("disposed", run), ["lane", "day"], F.col("id"))
    store.write("disposed_digests", run, sums)
    behind = dispositions.join(
        items.select("packet_sha256", F.col("item_id").alias("entry_id"), F.col("daily_result_sha256").alias("result_sha256")),
        ["packet_sha256", "entry_id"],
    )
    store.write("sweeps", run, apply.provenance_sets(behind).join(results, "packet_sha256"))
    store.commit("documents", run, {"documents": store.read_run("documents", run).count()})
    return run
