"""Checks of decision tables against the packets they answer.

Every check works on many packets at once, keyed by ``packet_sha256``, and
reports rows instead of stopping at the first problem.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.bounds import (
    MAX_BODY_BYTES,
    MAX_CHANGES,
    MAX_DAILY_ENTRIES,
    MAX_REASON_BYTES,
    MAX_REASON_CHARS,
    MAX_SOURCES_PER_OUTPUT,
    MAX_SUMMARY_BYTES,
    MAX_TARGETS_PER_DISPOSITION,
)
from ledgerloom.functions import ident, routes, text

# The closed vocabularies of decision tables.
OMISSION_REASONS = ("low_signal", "redundant", "sensitive", "unsupported")
ACTIONS = ("create", "replace")
STATUSES = ("promoted", "already_covered", "source_only", "promotion_debt")
CONFIDENCES = ("low", "medium", "high")

PACKET = "packet_sha256"


def _fails(condition: Column, rule: str) -> Column:
    return F.when(~F.coalesce(condition, F.lit(False)), F.lit(rule))


def _violations(df: DataFrame, subject: Column, rules: list[Column]) -> DataFrame:
    return df.select(
        PACKET,
        F.explode(F.array_compact(F.array(*rules))).alias("rule"),
        subject.cast("string").alias("subject"),
    )


def coverage(items: DataFrame, assigned: DataFrame) -> DataFrame:
    """Per packet and id: ``ok``, ``unknown``, ``repeated`` or ``missing``.

    ``assigned`` has one row per use of an id in any decision of the packet.
    """
    zero, one = F.lit(0).alias("uses"), F.lit(1).alias("uses")
    offered = items.select(PACKET, "item_id", zero, F.lit(1).alias("offers"))
    used = assigned.select(PACKET, "item_id", one, F.lit(0).alias("offers"))
    status = (
        F.when(F.col("offered") == 0, "unknown")
        .when(F.col("uses") == 0, "missing")
        .when(F.col("uses") > 1, "repeated")
        .otherwise("ok")
    )
    return (
        offered.unionByName(used)
        .groupBy(PACKET, "item_id")
        .agg(F.sum("uses").alias("uses"), F.max("offers").alias("offered"))
        .withColumn("status", status)
        .select(PACKET, "item_id", "uses", "status")
    )


def daily_assignments(entries: DataFrame, omitted: DataFrame) -> DataFrame:
    """One row per source of an entry and per omission."""
    sources = entries.select(PACKET, F.explode("source_record_ids").alias("item_id"))
    return sources.unionByName(omitted.select(PACKET, F.col("record_id").alias("item_id")))


def _coverage_violations(covered: DataFrame) -> DataFrame:
    return covered.where(F.col("status") != "ok").select(
        PACKET, F.concat(F.lit("coverage_"), F.col("status")).alias("rule"), F.col("item_id").alias("subject")
    )


def _too_many(df: DataFrame, limit: int, rule: str) -> DataFrame:
    counted = df.groupBy(PACKET).agg(F.count("*").alias("rows")).where(F.col("rows") > limit)
    return counted.select(PACKET, F.lit(rule).alias("rule"), F.col("rows").cast("string").alias("subject"))


def producer_violations(results: DataFrame) -> DataFrame:
    """Results whose producer columns are malformed.

    ``results`` holds (packet_sha256, kind, tool_version, model,
    reasoning_effort, isolation_profile); kind and profile only have to be named.
    """
    return _violations(
        results,
        F.col("model"),
        [
            _fails(text.is_safe_text(F.col("kind"), 200, 200, single_line=True), "producer_kind"),
            _fails(text.is_safe_text(F.col("tool_version"), 200, 200), "producer_version"),
            _fails(ident.is_model_id(F.col("model")), "producer_model"),
            _fails(ident.is_effort(F.col("reasoning_effort")), "producer_effort"),
            _fails(
                text.is_safe_text(F.col("isolation_profile"), 200, 200, single_line=True),
                "producer_profile",
            ),
        ],
    )


def producer_coverage(items: DataFrame, producers: DataFrame) -> DataFrame:
    """Packets that do not have exactly one producer, and producers of no packet."""
    offered = items.select(PACKET, F.lit(1).alias("offers"), F.lit(0).alias("rows"))
    named = producers.select(PACKET, F.lit(0).alias("offers"), F.lit(1).alias("rows"))
    rule = (
        F.when(F.col("offered") == 0, "producer_unknown")
        .when(F.col("named") == 0, "producer_missing")
        .when(F.col("named") > 1, "producer_repeated")
    )
    return (
        offered.unionByName(named)
        .groupBy(PACKET)
        .agg(F.max("offers").alias("offered"), F.sum("rows").alias("named"))
        .select(PACKET, rule.alias("rule"), F.col("named").cast("string").alias("subject"))
        .where("rule IS NOT NULL")
    )


def _with_producers(violations: DataFrame, items: DataFrame, producers: DataFrame | None) -> DataFrame:
    if producers is None:
        return violations
    return violations.unionByName(producer_violations(producers)).unionByName(producer_coverage(items, producers))


def validate_daily(
    items: DataFrame, entries: DataFrame, omitted: DataFrame, producers: DataFrame | None = None
) -> DataFrame:
    """All violations of daily decisions as (packet_sha256, rule, subject).

    ``items`` holds (packet_sha256, item_id), ``entries`` (packet_sha256,
    entry_no, source_record_ids, summary), ``omitted`` (packet_sha256,
    record_id, reason). ``producers``, as for ``producer_violations``, has one row
    a packet; without it producers are not checked.
    """
    sources = F.col("source_record_ids")
    entry_rules = [
        _fails(F.size(sources).between(1, MAX_SOURCES_PER_OUTPUT), "entry_source_count"),
        _fails(F.forall(sources, ident.is_hex64), "entry_source_id"),
        _fails(F.size(F.array_distinct(sources)) == F.size(sources), "entry_source_repeated"),
        _fails(text.is_safe_text(F.col("summary"), MAX_SUMMARY_BYTES), "entry_summary"),
    ]
    omission_rules = [
        _fails(ident.is_hex64(F.col("record_id")), "omission_id"),
        _fails(F.col("reason").isin(*OMISSION_REASONS), "omission_reason"),
    ]
    found = (
        _violations(entries, F.col("entry_no"), entry_rules)
        .unionByName(_violations(omitted, F.col("record_id"), omission_rules))
        .unionByName(_too_many(entries, MAX_DAILY_ENTRIES, "entry_count"))
        .unionByName(_coverage_violations(coverage(items, daily_assignments(entries, omitted))))
    )
    return _with_producers(found, items, producers)


def tally(items: DataFrame, entries: DataFrame, omitted: DataFrame, counts: DataFrame) -> DataFrame:
    """Per packet: entries, records included, omitted and not yet admitted."""

    def per_packet(df: DataFrame, value: Column, name: str) -> DataFrame:
        return df.groupBy(PACKET).agg(value.alias(name))

    entry_counts = entries.groupBy(PACKET).agg(
        F.count("*").alias("included_entries"),
        F.sum(F.size("source_record_ids")).alias("included_records"),
    )
    joined = (
        per_packet(items, F.count("*"), "items")
        .join(entry_counts, PACKET, "left")
        .join(per_packet(omitted, F.count("*"), "omitted_records"), PACKET, "left")
        .join(counts.select(PACKET, "not_yet_admitted"), PACKET, "left")
    )
    return joined.na.fill(0, ["included_entries", "included_records", "omitted_records"])


def preimage_check(changes: DataFrame, context: DataFrame) -> DataFrame:
    """Per change: whether its expected hash fits the frozen documents.

    ``context`` holds (packet_sha256, target_key, document_sha256).
    """
    frozen = context.select(PACKET, "target_key", "document_sha256")
    created = F.col("expected_sha256").isNull() & F.col("document_sha256").isNull()
    replaced = ident.is_hex64(F.col("expected_sha256")) & (
        F.col("expected_sha256") == F.col("document_sha256")
    )
    status = (
        F.when(F.col("action") == "create", F.when(created, "ok").otherwise("create_conflict"))
        .when(F.col("action") == "replace", F.when(replaced, "ok").otherwise("preimage_mismatch"))
        .otherwise("unknown_action")
    )
    return (
        changes.withColumn("target_key", routes.target_key(F.col("target")))
        .join(frozen, [PACKET, "target_key"], "left")
        .withColumn("status", F.coalesce(status, F.lit("preimage_mismatch")))
    )


def _disposition_targets(dispositions: DataFrame) -> DataFrame:
    return dispositions.select(
        PACKET, "entry_id", "status", F.explode("targets").alias("target")
    ).withColumn("target_key", routes.target_key(F.col("target")))


def unmatched_change_sources(changes: DataFrame, dispositions: DataFrame) -> DataFrame:
    """Sources of changes that no promoting disposition sends to the change's target."""
    used = changes.select(
        PACKET,
        routes.target_key(F.col("target")).alias("target_key"),
        F.explode("source_entry_ids").alias("entry_id"),
    )
    promoting = _disposition_targets(
        dispositions.where(F.col("status").isin("promoted", "promotion_debt"))
    ).select(PACKET, "target_key", "entry_id")
    return used.join(promoting, [PACKET, "target_key", "entry_id"], "left_anti")


def disposition_check(
    dispositions: DataFrame, changes: DataFrame, context: DataFrame
) -> DataFrame:
    """Per disposition: ``ok`` or how its targets break the rule of its status."""
    keys = [PACKET, "target_key"]
    in_context = context.select(*keys).distinct().withColumn("in_context", F.lit(True))
    in_changes = (
        changes.select(PACKET, routes.target_key(F.col("target")).alias("target_key"))
        .distinct()
        .withColumn("in_changes", F.lit(True))
    )
    found = (
        _disposition_targets(dispositions)
        .join(in_context, keys, "left")
        .join(in_changes, keys, "left")
        .groupBy(PACKET, "entry_id")
        .agg(
            F.bool_and(F.coalesce("in_context", F.lit(False))).alias("all_in_context"),
            F.bool_or(F.coalesce("in_changes", F.lit(False))).alias("any_in_changes"),
        )
    )
    targets = F.size("targets")
    problem = (
        F.when((F.col("status") == "source_only") & (targets > 0), "unexpected_targets")
        .when((F.col("status") != "source_only") & (targets == 0), "missing_targets")
        .when((F.col("status") == "already_covered") & ~F.col("all_in_context"), "not_in_context")
        .when((F.col("status") == "promoted") & ~F.col("any_in_changes"), "not_changed")
        .otherwise("ok")
    )
    return dispositions.join(found, [PACKET, "entry_id"], "left").select(
        PACKET, "entry_id", "status", targets.alias("targets"), problem.alias("outcome")
    )


def validate_structured(
    items: DataFrame,
    context: DataFrame,
    changes: DataFrame,
    dispositions: DataFrame,
    producers: DataFrame | None = None,
) -> DataFrame:
    """All violations of document decisions as (packet_sha256, rule, subject).

    ``items`` holds (packet_sha256, item_id), ``context`` (packet_sha256,
    target_key, document_sha256), ``changes`` (packet_sha256, change_no, action,
    target, expected_sha256, body, source_entry_ids, reason, confidence),
    ``dispositions`` (packet_sha256, entry_id, status, targets, reason);
    ``producers`` as for ``validate_daily``.
    """
    sources, targets = F.col("source_entry_ids"), F.col("targets")
    change_rules = [
        _fails(F.col("action").isin(*ACTIONS), "change_action"),
        _fails(routes.is_valid_target(F.col("target")), "change_target"),
        _fails(F.size(sources).between(0, MAX_SOURCES_PER_OUTPUT), "change_source_count"),
        _fails(F.size(F.array_distinct(sources)) == F.size(sources), "change_source_repeated"),
        _fails(text.is_safe_text(F.col("body"), MAX_BODY_BYTES), "change_body"),
        _fails(
            text.is_safe_text(F.col("reason"), MAX_REASON_BYTES, MAX_REASON_CHARS, single_line=True),
            "change_reason",
        ),
        _fails(F.col("confidence").isin(*CONFIDENCES), "change_confidence"),
    ]
    target_keys = F.transform(targets, routes.target_key)
    disposition_rules = [
        _fails(F.col("status").isin(*STATUSES), "disposition_status"),
        _fails(F.size(targets).between(0, MAX_TARGETS_PER_DISPOSITION), "disposition_target_count"),
        _fails(F.forall(targets, routes.is_valid_target), "disposition_target"),
        _fails(F.size(F.array_distinct(target_keys)) == F.size(targets), "disposition_target_repeated"),
        _fails(
            text.is_safe_text(F.col("reason"), MAX_REASON_BYTES, MAX_REASON_CHARS, single_line=True),
            "disposition_reason",
        ),
    ]
    keyed = changes.withColumn("target_key", routes.target_key(F.col("target")))
    repeated = (
        keyed.groupBy(PACKET, "target_key")
        .agg(F.count("*").alias("copies"))
        .where(F.col("copies") > 1)
        .select(PACKET, F.lit("change_target_repeated").alias("rule"), F.col("target_key").alias("subject"))
    )
    preimages = (
        preimage_check(changes, context)
        .where(F.col("status").isin("create_conflict", "preimage_mismatch"))
        .select(PACKET, F.concat(F.lit("change_"), F.col("status")).alias("rule"), F.col("target_key").alias("subject"))
    )
    unknown_sources = (
        changes.select(PACKET, F.explode("source_entry_ids").alias("item_id"))
        .join(items.select(PACKET, "item_id"), [PACKET, "item_id"], "left_anti")
        .select(PACKET, F.lit("change_source_unknown").alias("rule"), F.col("item_id").alias("subject"))
    )
    unmatched = unmatched_change_sources(changes, dispositions).select(
        PACKET, F.lit("change_source_unmatched").alias("rule"), F.concat_ws(" ", "target_key", "entry_id").alias("subject")
    )
    outcomes = (
        disposition_check(dispositions, changes, context)
        .where(F.col("outcome") != "ok")
        .select(PACKET, F.concat(F.lit("disposition_"), F.col("outcome")).alias("rule"), F.col("entry_id").alias("subject"))
    )
    covered = coverage(items, dispositions.select(PACKET, F.col("entry_id").alias("item_id")))
    parts = [
        _violations(changes, F.col("change_no"), change_rules),
        _violations(dispositions, F.col("entry_id"), disposition_rules),
        _too_many(changes, MAX_CHANGES, "change_count"),
        repeated,
        preimages,
        unknown_sources,
        unmatched,
        outcomes,
        _coverage_violations(covered),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return _with_producers(result, items, producers)
