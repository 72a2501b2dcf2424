"""From event lines to ledger records, and the checks between the two."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.bounds import MAX_EVENT_BYTES, MAX_MESSAGE_CHARS
from ledgerloom.functions import events, ident, text
from ledgerloom.functions.once import with_once

SCHEMA_VERSION = 1
TRANSFORM_VERSION = 1

LEDGER_SCHEMA = (
    "schema_version int, transform_version int, record_id string, captured_at string, "
    "role string, text string, text_sha256 string, "
    "provenance struct<source_ref:string,byte_start:bigint,byte_end:bigint,event_sha256:string>"
)
LEDGER_COLUMNS = (
    "schema_version",
    "transform_version",
    "record_id",
    "captured_at",
    "role",
    "text",
    "text_sha256",
    "provenance",
)


def parsed_events(
    lines: DataFrame, max_event_bytes: int = MAX_EVENT_BYTES, on_reject: str = "fail"
) -> DataFrame:
    """Non-blank lines with a strictly parsed ``event``.

    ``on_reject="fail"`` stops at the first bad line, ``"quarantine"`` keeps it
    with its ``reject_reason`` and a null event.
    """
    if on_reject not in ("fail", "quarantine"):
        raise ValueError("on_reject must be 'fail' or 'quarantine'")
    parsed = events.with_strict_event(
        lines.where(F.col("raw").isNull() | ~events.is_blank(F.col("raw"))), "raw", max_event_bytes
    )
    return events.fail_on_reject(parsed) if on_reject == "fail" else parsed


def messages(parsed: DataFrame, max_chars: int = MAX_MESSAGE_CHARS) -> DataFrame:
    """Add ``role``, ``text``, ``captured_at`` and ``supported`` to parsed events.

    Supported events are user or assistant messages with non-empty text; the
    others keep null text and are only counted.
    """
    event = F.col("event")
    named = with_once(
        parsed,
        role=events.message_role(event),
        _content=F.try_variant_get(event, "$.payload.content", "variant"),
        captured_at=events.captured_at(event),
    )
    content = F.when(F.col("role").isNotNull(), events.content_text(F.col("_content")))
    found = with_once(named, _found=content)
    bounded = with_once(found, text=text.bounded_text(F.col("_found"), max_chars))
    return (
        bounded.drop("_content", "_found")
        .withColumn("text", F.when(F.col("text") != "", F.col("text")))
        .withColumn("supported", F.col("text").isNotNull())
    )


def with_identity(
    found: DataFrame,
    ns: ident.Namespaces = ident.DEFAULT_NAMESPACES,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Ledger records of messages, with the columns in ``keep``."""
    return (
        found.withColumn("source_ref", ident.source_ref(F.col("source"), ns))
        .select(
            F.lit(SCHEMA_VERSION).alias("schema_version"),
            F.lit(TRANSFORM_VERSION).alias("transform_version"),
            ident.record_id(
                F.col("source_ref"), F.col("byte_start"), F.col("byte_end"), F.col("event_sha256"), ns
            ).alias("record_id"),
            "captured_at",
            "role",
            "text",
            ident.sha256_hex(F.col("text")).alias("text_sha256"),
            F.struct("source_ref", "byte_start", "byte_end", "event_sha256").alias("provenance"),
            *keep,
        )
    )


def ledger_records(
    lines: DataFrame,
    max_chars: int = MAX_MESSAGE_CHARS,
    max_event_bytes: int = MAX_EVENT_BYTES,
    on_reject: str = "fail",
    ns: ident.Namespaces = ident.DEFAULT_NAMESPACES,
) -> DataFrame:
    found = messages(parsed_events(lines, max_event_bytes, on_reject), max_chars)
    return with_identity(found.where("supported"), ns)


def to_json_lines(ledger: DataFrame) -> DataFrame:
    """One canonical JSON record per row."""
    fields = {name: F.col(name) for name in LEDGER_COLUMNS if name != "provenance"}
    inner = ("byte_end", "byte_start", "event_sha256", "source_ref")
    fields["provenance"] = F.struct(*[F.col(f"provenance.{name}") for name in inner])
    return ledger.select(ident.canonical_json(fields).alias("value"))


def from_json_lines(lines: DataFrame) -> DataFrame:
    """Ledger records from JSON lines; a line that is not a record stops the job."""
    options = {"mode": "FAILFAST"}
    return lines.select(F.from_json("value", LEDGER_SCHEMA, options).alias("r")).select("r.*")


def record_content_sha256() -> Column:
    """Hash of everything in a record but its id."""
    names = [name for name in LEDGER_COLUMNS if name not in ("record_id", "text")]
    return ident.digest({name: F.col(name) for name in names})


def new_records(candidates: DataFrame, ledger: DataFrame) -> DataFrame:
    return candidates.join(ledger.select("record_id"), "record_id", "left_anti")


def classify_candidates(candidates: DataFrame, ledger: DataFrame) -> DataFrame:
    """Per candidate: ``new``, ``duplicate`` (exact replay) or ``conflict``."""
    known = ledger.select("record_id", record_content_sha256().alias("known_sha256"))
    status = (
        F.when(F.col("known_sha256").isNull(), "new")
        .when(F.col("known_sha256") == F.col("content_sha256"), "duplicate")
        .otherwise("conflict")
    )
    return (
        candidates.withColumn("content_sha256", record_content_sha256())
        .join(known, "record_id", "left")
        .withColumn("status", status)
        .drop("known_sha256")
    )


def replay_conflicts(candidates: DataFrame, ledger: DataFrame) -> DataFrame:
    """Candidates whose id is in the ledger with other content."""
    known = ledger.select("record_id", record_content_sha256().alias("ledger_sha256"))
    return (
        candidates.withColumn("candidate_sha256", record_content_sha256())
        .join(known, "record_id")
        .where(F.col("candidate_sha256") != F.col("ledger_sha256"))
    )


def unproven_tail(tail: DataFrame, candidates: DataFrame) -> DataFrame:
    """Rows written after the last commit that are not exact replays of candidates."""
    known = candidates.select("record_id", record_content_sha256().alias("candidate_sha256"))
    return (
        tail.withColumn("tail_sha256", record_content_sha256())
        .join(known, "record_id", "left")
        .where(~F.col("tail_sha256").eqNullSafe(F.col("candidate_sha256")))
    )


def missing_sources(saved: DataFrame, files: DataFrame) -> DataFrame:
    """Tracked sources that are no longer listed."""
    return saved.join(files.select("source"), "source", "left_anti")


def prefix_violations(saved: DataFrame, current: DataFrame) -> DataFrame:
    """Saved byte ranges whose bytes changed or no longer exist.

    Both sides hold (source, range_start, range_end, sha256). Hashing ranges
    instead of one whole prefix lets a source of any size be checked in parallel.
    """
    keys = ["source", "range_start", "range_end"]
    now = current.select(*keys, F.col("sha256").alias("current_sha256"))
    return saved.join(now, keys, "left").where(
        ~F.col("sha256").eqNullSafe(F.col("current_sha256"))
    )


def duplicate_ids(df: DataFrame, id_column: str) -> DataFrame:
    return df.groupBy(id_column).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def ingest_counters(found: DataFrame, ledger: DataFrame, frontier: DataFrame) -> DataFrame:
    """One row: new, duplicate, sources, pending bytes, unsupported.

    ``found`` are the parsed messages and other events of an ingest; they are
    read once, and conflicts with the ledger are left to ``replay_conflicts``.
    """
    pending = F.coalesce(F.sum(F.col("length") - F.col("consumed")), F.lit(0))
    sources = frontier.agg(
        F.struct(F.count("*").alias("sources_checked"), pending.alias("pending_bytes"))
    )
    known = ledger.select("record_id", F.lit(True).alias("known"))
    supported, is_known = F.col("supported"), F.col("known").isNotNull()
    counts = (
        with_identity(found, keep=("supported",))
        .select("record_id", "supported")
        .join(known, "record_id", "left")
        .agg(
            F.count_if(supported & ~is_known).alias("new_records"),
            F.count_if(supported & is_known).alias("duplicate_records"),
            F.count_if(~supported).alias("unsupported_events"),
        )
    )
    return counts.select("*", sources.scalar().alias("_sources")).select(
        "new_records", "duplicate_records", "_sources.*", "unsupported_events"
    )


def ledger_rules() -> dict[str, Column]:
    """Conditions every ledger row must meet."""
    place = "provenance"
    start, end = F.col(f"{place}.byte_start"), F.col(f"{place}.byte_end")

    def length_is(column: str, size: int) -> Column:
        return F.char_length(column) == size

    return {
        "schema_version": F.col("schema_version") == SCHEMA_VERSION,
        "transform_version": F.col("transform_version") == TRANSFORM_VERSION,
        "record_id": length_is("record_id", 64),
        "role": F.col("role").isin(*events.MESSAGE_ROLES),
        "text": F.col("text").isNotNull(),
        "text_sha256": length_is("text_sha256", 64),
        "source_ref": length_is(f"{place}.source_ref", 16),
        "byte_range": (start >= 0) & (end >= start),
        "event_sha256": length_is(f"{place}.event_sha256", 64),
    }


def ledger_violations(ledger: DataFrame) -> DataFrame:
    """One row per record and broken rule, in one pass without a shuffle."""
    broken = [
        F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in ledger_rules().items()
    ]
    return ledger.withColumn("rule", F.explode(F.array_compact(F.array(*broken))))
