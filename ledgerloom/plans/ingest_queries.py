"""Scanning, message extraction and ledger checks over the sample logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import events, ident
from ledgerloom.operators import ledger
from ledgerloom.plans import oracle_ctes as o
from ledgerloom.plans.registry import query
from ledgerloom.plans.sample_tables import event_lines, listed_logs, parsed_ledger, sample_ledger, table
from ledgerloom.sources import byte_ranges

# The logs on disk end without a newline, so their last line is not complete.
_COMPLETE = """,
ranked AS (SELECT *, max(byte_end) OVER (PARTITION BY source) AS total FROM event_lines),
complete AS (SELECT * FROM ranked WHERE byte_end < total)
"""


def flat(records: DataFrame) -> DataFrame:
    return records.select(
        "record_id", "captured_at", "role", "text", "text_sha256", "provenance.*"
    )


def _frontier(spark: SparkSession, sf: str, offsets: DataFrame | None = None) -> DataFrame:
    return byte_ranges.with_frontier(
        listed_logs(spark, sf), offsets, spark.sparkContext.defaultParallelism
    )


def _scan(spark: SparkSession, frontier: DataFrame) -> DataFrame:
    tasks = byte_ranges.task_count(spark, frontier)
    return byte_ranges.read_lines(byte_ranges.byte_ranges(frontier), tasks)


@query(
    "scan_byte_lines",
    o.with_(
        o.EVENT_LINES + _COMPLETE,
        "SELECT source, byte_start, byte_end, sha256(line) AS event_sha256 FROM complete",
    ),
)
def scan_byte_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Complete lines of all log files with their byte addresses."""
    lines = _scan(spark, _frontier(spark, sf))
    return lines.select("source", "byte_start", "byte_end", F.sha2("raw", 256).alias("event_sha256"))


@query(
    "pending_tail_bytes",
    o.with_(
        o.EVENT_LINES + _COMPLETE,
        """SELECT source, CAST(max(total) - 1 AS BIGINT) AS length,
           CAST(coalesce(max(byte_end) FILTER (WHERE byte_end < total), 0) AS BIGINT) AS consumed,
           CAST(max(total) - 1 - coalesce(max(byte_end) FILTER (WHERE byte_end < total), 0) AS BIGINT) AS pending_bytes
           FROM ranked GROUP BY source""",
    ),
)
def pending_tail_bytes(spark: SparkSession, sf: str) -> DataFrame:
    return byte_ranges.pending_tails(_frontier(spark, sf))


def _saved_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """Offsets saved when every log held only its conversations' first two turns and what lies before."""
    return event_lines(spark, sf).where(F.col("turn") < 2).groupBy("source").agg(
        F.min("byte_end").alias("first_end"), F.max("byte_end").alias("offset")
    )


_OFFSETS = """,
offsets AS (SELECT source, min(byte_end) AS first_end, max(byte_end) AS saved FROM event_lines
            WHERE turn < 2 GROUP BY source)
"""


@query(
    "incremental_resume",
    o.with_(
        o.EVENT_LINES + _COMPLETE + _OFFSETS,
        """SELECT source, byte_start, byte_end, sha256(line) AS event_sha256
           FROM complete JOIN offsets USING (source) WHERE byte_start >= first_end""",
    ),
)
def incremental_resume(spark: SparkSession, sf: str) -> DataFrame:
    """Only the bytes after each log's saved offset, here the end of its first line."""
    offsets = _saved_offsets(spark, sf).select("source", F.col("first_end").alias("offset"))
    lines = _scan(spark, _frontier(spark, sf, offsets))
    return lines.select("source", "byte_start", "byte_end", F.sha2("raw", 256).alias("event_sha256"))


@query(
    "prefix_check",
    o.with_(
        o.EVENT_LINES + _OFFSETS,
        """SELECT * FROM (SELECT source, CAST(first_end AS BIGINT) AS range_end,
           sha256(string_agg(line, '' ORDER BY byte_start)) AS current_sha256
           FROM event_lines JOIN offsets USING (source) WHERE byte_end <= first_end
           GROUP BY source, first_end) WHERE current_sha256 < '8'""",
    ),
)
def prefix_check(spark: SparkSession, sf: str) -> DataFrame:
    """Saved ranges of logs against the files; the saved hash of some logs is of other bytes."""
    prefix = _saved_offsets(spark, sf).select("source", F.col("first_end").alias("consumed"))
    files = listed_logs(spark, sf).join(prefix, "source").withColumn("offset", F.lit(0).cast("bigint"))
    ranges = byte_ranges.byte_ranges(files)
    current = byte_ranges.hash_ranges(ranges, spark.sparkContext.defaultParallelism)
    stale = F.col("sha256") < "8"
    saved = current.select(
        "source",
        "range_start",
        "range_end",
        F.when(stale, F.sha2("sha256", 256)).otherwise(F.col("sha256")).alias("sha256"),
    )
    return ledger.prefix_violations(saved, current).select("source", "range_end", "current_sha256")


@query(
    "missing_sources",
    """SELECT DISTINCT printf('log-%06d-%03d.jsonl', conv_id // 16, 0) || '.old' AS source
       FROM conversations WHERE role = 'system'""",
)
def missing_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Tracked logs that are gone: here, renamed copies of logs that have a system turn."""
    lines = event_lines(spark, sf)
    tracked = lines.select("source").unionByName(
        lines.where(F.col("raw").cast("string").contains('"role":"system"')).select(
            F.concat(F.regexp_replace("source", r"-\d+\.jsonl$", "-000.jsonl"), F.lit(".old")).alias("source")
        )
    )
    return ledger.missing_sources(tracked.distinct(), listed_logs(spark, sf))


@query(
    "event_size_guard",
    o.with_(
        o.EVENT_LINES,
        """SELECT source, byte_start, CAST(strlen(line) AS BIGINT) AS bytes FROM event_lines
           WHERE strlen(line) > 1000""",
    ),
)
def event_size_guard(spark: SparkSession, sf: str) -> DataFrame:
    checked = events.with_strict_event(event_lines(spark, sf), max_event_bytes=1_000)
    return checked.where(F.col("reject_reason") == "oversize").select(
        "source", "byte_start", F.octet_length("raw").cast("bigint").alias("bytes")
    )


@query(
    "extract_text",
    o.with_(
        o.EVENT_LINES,
        "SELECT source, byte_start, CASE WHEN role <> 'system' THEN role END AS role, captured_at, text FROM event_lines",
    ),
)
def extract_text(spark: SparkSession, sf: str) -> DataFrame:
    parsed = ledger.parsed_events(event_lines(spark, sf))
    event = F.col("event")
    return parsed.select(
        "source",
        "byte_start",
        events.message_role(event).alias("role"),
        events.captured_at(event).alias("captured_at"),
        events.message_text(event).alias("text"),
    )


@query(
    "message_filter",
    o.with_(
        o.EVENT_LINES,
        f"""SELECT source, count(*) FILTER (WHERE role IN ('user', 'assistant') AND ({o.bounded('text')}) <> '') AS messages,
            count(*) FILTER (WHERE NOT (role IN ('user', 'assistant') AND ({o.bounded('text')}) <> '')) AS unsupported
            FROM event_lines GROUP BY source""",
    ),
)
def message_filter(spark: SparkSession, sf: str) -> DataFrame:
    found = ledger.messages(ledger.parsed_events(event_lines(spark, sf)))
    return found.groupBy("source").agg(
        F.count_if(F.col("supported")).alias("messages"),
        F.count_if(~F.col("supported")).alias("unsupported"),
    )


@query(
    "source_ref",
    o.with_(o.LEDGER, "SELECT DISTINCT source, source_ref FROM refs"),
)
def source_ref(spark: SparkSession, sf: str) -> DataFrame:
    sources = event_lines(spark, sf).select("source").distinct()
    return sources.withColumn("source_ref", ident.source_ref(F.col("source")))


@query(
    "record_identity",
    o.with_(o.LEDGER, "SELECT source_ref, byte_start, byte_end, event_sha256, record_id FROM ledger"),
)
def record_identity(spark: SparkSession, sf: str) -> DataFrame:
    return flat(parsed_ledger(spark, sf)).drop("captured_at", "role", "text", "text_sha256")


@query(
    "ledger_build",
    o.with_(
        o.LEDGER,
        """SELECT record_id, captured_at, role, text, text_sha256, source_ref, byte_start, byte_end, event_sha256
           FROM ledger""",
    ),
)
def ledger_build(spark: SparkSession, sf: str) -> DataFrame:
    """The ledger exported as JSON lines and read back under its closed schema."""
    return flat(ledger.from_json_lines(ledger.to_json_lines(parsed_ledger(spark, sf))))


@query(
    "ledger_constraints",
    o.with_(
        o.LEDGER,
        """SELECT record_id, unnest(list_filter([CASE WHEN role = 'assistant' THEN 'role' END,
             CASE WHEN strlen(text) > 1000 THEN 'text_sha256' END,
             CASE WHEN byte_start > 5000 THEN 'byte_range' END], lambda r: r IS NOT NULL)) AS rule
           FROM ledger""",
    ),
)
def ledger_constraints(spark: SparkSession, sf: str) -> DataFrame:
    """Rule breaks of a ledger whose assistant role, long texts' hashes and far byte ends are damaged."""
    damaged = (
        sample_ledger(spark, sf)
        .withColumn("role", F.when(F.col("role") == "assistant", "model").otherwise(F.col("role")))
        .withColumn(
            "text_sha256",
            F.when(F.octet_length("text") > 1_000, F.substring("text_sha256", 1, 63)).otherwise(F.col("text_sha256")),
        )
        .withColumn(
            "provenance",
            F.col("provenance").withField(
                "byte_end",
                F.when(F.col("provenance.byte_start") > 5_000, F.col("provenance.byte_start") - 1).otherwise(
                    F.col("provenance.byte_end")
                ),
            ),
        )
    )
    return ledger.ledger_violations(damaged).select("record_id", "rule")


def _existing(records: DataFrame) -> DataFrame:
    """The ledger before the second day's logs came in."""
    return records.where(F.col("captured_at") < "2024-01-02")


@query(
    "new_records",
    o.with_(o.LEDGER, "SELECT record_id, captured_at FROM ledger WHERE NOT captured_at < '2024-01-02'"),
)
def new_records(spark: SparkSession, sf: str) -> DataFrame:
    records = sample_ledger(spark, sf)
    return ledger.new_records(records, _existing(records)).select("record_id", "captured_at")


def _diverging(records: DataFrame) -> DataFrame:
    """Existing records, where those of assistants were kept with another text bound."""
    return _existing(records).withColumn(
        "text_sha256",
        F.when(F.col("role") == "assistant", F.sha2(F.substring("text", 1, 64), 256)).otherwise(F.col("text_sha256")),
    )


@query(
    "replay_conflicts",
    o.with_(
        o.LEDGER,
        """SELECT record_id, role FROM ledger WHERE captured_at < '2024-01-02' AND role = 'assistant'
           AND length(text) > 64""",
    ),
)
def replay_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    records = sample_ledger(spark, sf)
    return ledger.replay_conflicts(records, _diverging(records)).select("record_id", "role")


@query(
    "crash_replay",
    o.with_(
        o.LEDGER,
        """SELECT record_id, CASE WHEN captured_at >= '2024-01-02' THEN 'new'
             WHEN role = 'assistant' AND length(text) > 64 THEN 'conflict' ELSE 'duplicate' END AS status
           FROM ledger""",
    ),
)
def crash_replay(spark: SparkSession, sf: str) -> DataFrame:
    """What a replay after a crash finds: new rows, exact replays and conflicts."""
    records = sample_ledger(spark, sf)
    return ledger.classify_candidates(records, _diverging(records)).select("record_id", "status")


@query(
    "ingest_counters",
    o.with_(
        o.LEDGER + _COMPLETE,
        """SELECT count(*) FILTER (WHERE captured_at >= '2024-01-02') AS new_records,
           count(*) FILTER (WHERE captured_at < '2024-01-02') AS duplicate_records,
           any_value(s.sources_checked) AS sources_checked, any_value(s.pending_bytes) AS pending_bytes,
           any_value(u.unsupported_events) AS unsupported_events
           FROM ledger, (SELECT count(*) AS sources_checked, CAST(sum(p) AS BIGINT) AS pending_bytes FROM (
             SELECT source, max(total) - 1 - coalesce(max(byte_end) FILTER (WHERE byte_end < total), 0) AS p
             FROM ranked GROUP BY source)) s,
           (SELECT count(*) - (SELECT count(*) FROM ledger) AS unsupported_events FROM event_lines) u""",
    ),
)
def ingest_counters(spark: SparkSession, sf: str) -> DataFrame:
    found = ledger.messages(ledger.parsed_events(event_lines(spark, sf)))
    return ledger.ingest_counters(found, _existing(sample_ledger(spark, sf)), _frontier(spark, sf))


@query(
    "duplicate_ids",
    o.with_(
        o.LEDGER,
        """SELECT text_sha256, count(*) AS copies FROM ledger GROUP BY 1 HAVING count(*) > 1
           UNION ALL SELECT sha256(text), count(*) FROM documents GROUP BY 1 HAVING count(*) > 1""",
    ),
)
def duplicate_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Repeated text hashes of messages and of documents; record ids themselves are unique."""
    documents = table(spark, sf, "documents").select(F.sha2("text", 256).alias("text_sha256"))
    messages = ledger.duplicate_ids(sample_ledger(spark, sf), "text_sha256")
    return messages.unionByName(ledger.duplicate_ids(documents, "text_sha256"))
