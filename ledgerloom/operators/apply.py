"""Turning accepted decisions into batches, commits and cursors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.bounds import MAX_COMMITS_PER_DAY
from ledgerloom.functions import ident, text
from ledgerloom.operators.groups import first_rows

PACKET = "packet_sha256"
#: Leading digits of a commit's hash by which a day's commits are hashed in parts.
COMMIT_PREFIX = 3


def result_hashes(entries: DataFrame, omitted: DataFrame, packets: DataFrame) -> DataFrame:
    """Hash of every packet's decisions. Decisions are bounded per packet."""
    kept = entries.groupBy(PACKET).agg(
        F.to_json(
            F.array_sort(F.collect_list(F.struct("entry_no", "source_record_ids", "summary")))
        ).alias("entries_json"),
        F.count("*").alias("included"),
    )
    dropped = omitted.groupBy(PACKET).agg(
        F.to_json(F.array_sort(F.collect_list(F.struct("record_id", "reason")))).alias("omitted_json"),
        F.count("*").alias("omitted"),
    )
    zero = F.lit(0).cast("bigint")
    body = F.concat_ws(
        "\n", PACKET, F.coalesce("entries_json", F.lit("[]")), F.coalesce("omitted_json", F.lit("[]"))
    )
    return (
        packets.select(PACKET)
        .join(kept, PACKET, "left")
        .join(dropped, PACKET, "left")
        .select(
            PACKET,
            ident.sha256_hex(body).alias("result_sha256"),
            F.coalesce("included", zero).alias("included"),
            F.coalesce("omitted", zero).alias("omitted"),
        )
    )


def daily_batches(packets: DataFrame, entries: DataFrame, omitted: DataFrame) -> DataFrame:
    """One row per packet: its batch id and counts. All-omitted packets give a batch too."""
    hashes = result_hashes(entries, omitted, packets)
    return packets.join(hashes, PACKET).withColumn(
        "batch_id", ident.batch_id(F.col(PACKET), F.col("result_sha256"))
    )


def daily_entries(batches: DataFrame, entries: DataFrame) -> DataFrame:
    """Entries with identities that bind packet, position, sources and summary."""
    return entries.join(batches.select(PACKET, "batch_id", "day"), PACKET).withColumn(
        "entry_id",
        ident.entry_id(
            F.col(PACKET), F.col("entry_no"), F.col("source_record_ids"), F.col("summary")
        ),
    )


def batch_documents(batches: DataFrame, entries: DataFrame) -> DataFrame:
    """Markdown of every batch: a list of inert summaries, then a table of what the batch binds."""
    short = F.transform("source_record_ids", lambda one: F.substring(one, 1, 12))
    block = F.concat(
        F.col("entry_no").cast("string"), F.lit(") "), text.inert_markdown(F.col("summary")),
        F.lit("\n   (entry "), F.substring("entry_id", 1, 12), F.lit(", from "), F.array_join(short, " "), F.lit(")\n\n"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("entry_no", block.alias("block"))))
    blocks = entries.groupBy("batch_id").agg(
        F.array_join(F.transform(ordered, lambda row: row["block"]), "").alias("body")
    )
    bound = [(name, F.col(name)) for name in (PACKET, "result_sha256", "included", "omitted", "not_yet_admitted")]
    rows = [F.concat(F.lit(f"| {name} | "), value.cast("string"), F.lit(" |\n")) for name, value in bound]
    document = F.concat(
        F.lit("# "), F.col("day").cast("string"), F.lit(", decided ("), F.col("timezone"), F.lit(")\n\n"),
        F.coalesce("body", F.lit("")),
        F.lit("| binds | value |\n| --- | --- |\n"), *rows,
    )
    return batches.join(blocks, "batch_id", "left").select("batch_id", "day", document.alias("document"))


def commit_rows(batches: DataFrame, documents: DataFrame) -> DataFrame:
    """Rows that bind a batch to the hashes of everything written for it."""
    plan = {
        "batch_id": F.col("batch_id"),
        "day": F.col("day").cast("string"),
        "packet_sha256": F.col(PACKET),
        "result_sha256": F.col("result_sha256"),
    }
    return (
        batches.join(documents.select("batch_id", F.sha2("document", 256).alias("document_sha256")), "batch_id")
        .withColumn("plan_sha256", ident.digest(plan))
        .withColumn(
            "commit_sha256",
            ident.digest({name: F.col(name) for name in ("batch_id", "document_sha256", "plan_sha256")}),
        )
        .select("batch_id", "day", PACKET, "result_sha256", "document_sha256", "plan_sha256", "commit_sha256")
    )


def verify_commits(committed: DataFrame, recomputed: DataFrame) -> DataFrame:
    """Per committed batch: whether what it binds is there unchanged."""
    fresh = recomputed.select(
        "batch_id", F.col("commit_sha256").alias("fresh_sha256")
    )
    outcome = (
        F.when(F.col("fresh_sha256").isNull(), "missing")
        .when(F.col("fresh_sha256") == F.col("commit_sha256"), "ok")
        .otherwise("changed")
    )
    return committed.join(fresh, "batch_id", "left").withColumn("outcome", outcome).drop("fresh_sha256")


def write_once(incoming: DataFrame, existing: DataFrame, key: str, content: str) -> DataFrame:
    """Per incoming row: ``new``, ``identical`` or ``conflict`` with what is stored."""
    stored = existing.select(key, F.col(content).alias("_stored"))
    status = (
        F.when(F.col("_stored").isNull(), "new")
        .when(F.col("_stored") == F.col(content), "identical")
        .otherwise("conflict")
    )
    return incoming.join(stored, key, "left").withColumn("status", status).drop("_stored")


def unapplied(batches: DataFrame, applied: DataFrame) -> DataFrame:
    """Batches not applied yet; a batch that was applied is skipped."""
    return batches.join(applied.select("batch_id"), "batch_id", "left_anti")


def advance_cursor(accounted: DataFrame, admitted: DataFrame) -> DataFrame:
    """Accounted ids after a batch: the union of both sides without repeats."""
    columns = ["lane", "day", "id"]
    return accounted.select(*columns).unionByName(admitted.select(*columns)).distinct()


def entries_with_results(entries: DataFrame, batches: DataFrame) -> DataFrame:
    """Attach the committed result hash to entries."""
    return entries.join(batches.select("batch_id", "result_sha256"), "batch_id")


def provenance_sets(disposed: DataFrame) -> DataFrame:
    """Per packet: the distinct result hashes behind its disposed entries, sorted.

    ``disposed`` holds (packet_sha256, entry_id, result_sha256); a packet is bounded.
    """
    hashes = F.array_sort(F.collect_set("result_sha256"))
    return disposed.groupBy(PACKET).agg(
        F.array_join(hashes, ",").alias("result_sha256s"), F.size(hashes).alias("results")
    )


def commit_digests(commits: DataFrame) -> DataFrame:
    """(day, source_version): a hash over all commits of every day, however many there are."""
    prefix = F.substring("commit_sha256", 1, COMMIT_PREFIX)
    parts = commits.groupBy("day", prefix.alias("prefix")).agg(
        ident.sha256_hex(F.array_join(F.array_sort(F.collect_list("commit_sha256")), "\n")).alias("part")
    )
    ordered = F.array_sort(F.collect_list(F.struct("prefix", "part")))
    joined = F.array_join(F.transform(ordered, lambda row: row["part"]), "\n")
    return parts.groupBy("day").agg(ident.sha256_hex(joined).alias("source_version"))


def sweep_results(packets: DataFrame, changes: DataFrame, dispositions: DataFrame) -> DataFrame:
    """(packet_sha256, result_sha256): a hash over all decisions of every packet, which are bounded."""

    def listed(rows: DataFrame, name: str) -> DataFrame:
        fields = [c for c in sorted(rows.columns) if c != PACKET]
        digest = ident.sha256_hex(F.to_json(F.struct(*fields)))
        return rows.groupBy(PACKET).agg(F.array_join(F.array_sort(F.collect_list(digest)), ",").alias(name))

    body = F.concat_ws("\n", PACKET, F.coalesce("_changes", F.lit("")), F.coalesce("_dispositions", F.lit("")))
    return (
        packets.select(PACKET)
        .join(listed(changes, "_changes"), PACKET, "left")
        .join(listed(dispositions, "_dispositions"), PACKET, "left")
        .select(PACKET, ident.sha256_hex(body).alias("result_sha256"))
    )


def commit_lists(commits: DataFrame) -> DataFrame:
    """Commit hashes of every day in batch order.

    A day with more commits than its bound stops the job before they are gathered.
    """
    allowed = first_rows(
        commits.select("day", "batch_id", "commit_sha256"), ["day"], ["batch_id"], MAX_COMMITS_PER_DAY + 1
    )
    excess = F.raise_error(F.concat(F.lit("too many commits for "), F.col("day").cast("string")))
    checked = F.when(F.col("seq") > MAX_COMMITS_PER_DAY, excess.cast("string")).otherwise(F.col("commit_sha256"))
    ordered = F.array_sort(F.collect_list(F.struct("seq", checked.alias("commit_sha256"))))
    return allowed.groupBy("day").agg(F.transform(ordered, lambda c: c["commit_sha256"]).alias("commits"))


def commit_set_matches(packets: DataFrame, commits: DataFrame) -> DataFrame:
    """Per packet: whether its day still has exactly the commits it was built from.

    ``packets`` holds (packet_sha256, day, commits), a bounded list in batch
    order; ``commits`` (day, batch_id, commit_sha256).
    """
    current = commit_lists(commits).select("day", F.col("commits").alias("current"))
    nothing = F.array().cast("array<string>")
    return packets.join(current, "day", "left").select(
        PACKET,
        "day",
        F.size("commits").alias("frozen_commits"),
        F.size(F.coalesce("current", nothing)).alias("current_commits"),
        (F.col("commits") == F.coalesce("current", nothing)).alias("unchanged"),
    )
