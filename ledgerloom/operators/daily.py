"""Daily selection and digests."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.bounds import DigestBounds
from ledgerloom.functions import ident, text, times
from ledgerloom.functions.once import with_once
from ledgerloom.operators.groups import budgeted_prefix, numbered

# Chronological order is that of the timestamp string, then of the record id.
DAILY_ORDER = ("captured_at", "record_id")


def with_local_day(ledger: DataFrame, zone: str = "UTC") -> DataFrame:
    """Add ``day``; records without a usable timestamp belong to no day.

    A stored ledger holds the parsed instant, so its timestamps are not parsed again.
    """
    if "captured_utc" in ledger.columns:
        dated = ledger.where(F.col("captured_utc").isNotNull()).withColumn(
            "day", times.day_in_zone(F.col("captured_utc"), zone)
        )
    else:
        dated = with_once(ledger, day=times.local_day(F.col("captured_at"), zone))
    return dated.where(F.col("day").isNotNull())


def select_day(ledger: DataFrame, day: date | str, zone: str = "UTC") -> DataFrame:
    """Records of one local day.

    If the ledger is stored by ``utc_day`` the range of days that can match is
    added as a filter, so other partitions are not read.
    """
    if "utc_day" in ledger.columns:
        low, high = times.utc_day_range(day)
        ledger = ledger.where(F.col("utc_day").between(low, high))
    return with_local_day(ledger, zone).where(F.col("day") == F.lit(str(day)).cast("date"))


def daily_order(records: DataFrame, folder: str) -> DataFrame:
    """Number the records of every day in chronological order in ``seq``.

    Digests and packets need only the first records of a day and do not use
    this; it is for reports over whole days. See ``numbered`` for ``folder``.
    """
    return numbered(records, ["day"], DAILY_ORDER, folder)


def digest_items(records: DataFrame, bounds: DigestBounds | None = None) -> DataFrame:
    """Records that enter each day's digest, in order, with their excerpts."""
    bounds = bounds or DigestBounds()
    chosen = budgeted_prefix(
        records,
        ["day"],
        DAILY_ORDER,
        lambda body: text.excerpt(body, bounds.excerpt_bytes),
        bounds.max_records,
        bounds.max_bytes,
    )
    return chosen.select(
        "day",
        "seq",
        "record_id",
        "role",
        "text_sha256",
        "provenance",
        F.col("bounded").alias("excerpt"),
        F.col("bounded_bytes").alias("excerpt_bytes"),
    )


def _block() -> Column:
    """One digest item: a bold number with role and origin, then the excerpt as a quotation."""
    start, end = F.col("provenance.byte_start"), F.col("provenance.byte_end")
    origin = F.concat_ws(
        " · ",
        F.concat(F.lit("**"), F.col("seq").cast("string"), F.lit("** "), F.col("role")),
        F.substring("record_id", 1, 12),
        F.concat(
            F.col("provenance.source_ref"), F.lit(" @ "), start.cast("string"), F.lit(" + "), (end - start).cast("string")
        ),
        F.substring("text_sha256", 1, 12),
    )
    return F.concat(origin, F.lit("\n\n> "), F.col("excerpt"), F.lit("\n\n"))


def selected_days(items: DataFrame, with_blocks: bool = False) -> DataFrame:
    """Per day: number of selected records and the hash of what was selected.

    A day holds at most the digest bound of items. ``with_blocks`` adds their
    Markdown blocks, joined in order.
    """
    fields = ["seq", "record_id", "text_sha256"]
    if with_blocks:
        items, fields = items.withColumn("block", _block()), [*fields, "block"]
    grouped = items.groupBy("day").agg(
        F.count("*").alias("records"),
        F.sum("excerpt_bytes").alias("excerpt_bytes"),
        F.array_sort(F.collect_list(F.struct(*fields))).alias("selected"),
    )
    pairs = F.transform("selected", lambda row: F.struct(row["record_id"].alias("record_id"), row["text_sha256"].alias("text_sha256")))
    columns = ["day", "records", "excerpt_bytes", ident.sha256_hex(F.to_json(pairs)).alias("selection_sha256")]
    if with_blocks:
        columns.append(F.array_join(F.transform("selected", lambda row: row["block"]), "").alias("blocks"))
    return grouped.select(*columns)


def _with_omitted(records: DataFrame, chosen: DataFrame, days: DataFrame | None) -> DataFrame:
    available = records.groupBy("day").agg(F.count("*").alias("available"))
    listed = available if days is None else days.select("day").distinct().join(available, "day", "left")
    empty = ident.sha256_hex(F.lit("[]"))
    zero = F.lit(0).cast("bigint")
    return (
        listed.join(chosen, "day", "left")
        .withColumn("records", F.coalesce("records", zero))
        .withColumn("excerpt_bytes", F.coalesce("excerpt_bytes", zero))
        .withColumn("omitted", F.coalesce("available", zero) - F.col("records"))
        .withColumn("selection_sha256", F.coalesce("selection_sha256", empty))
    )


def digest_summary(
    records: DataFrame, bounds: DigestBounds | None = None, days: DataFrame | None = None
) -> DataFrame:
    """Per day: selected, omitted and the selection hash.

    ``days`` lists the days to report; days without records get an empty digest.
    Without it every day that has records is reported.
    """
    chosen = selected_days(digest_items(records, bounds))
    return _with_omitted(records, chosen, days).select(
        "day", "records", "omitted", "excerpt_bytes", "selection_sha256"
    )


def digest_documents(
    records: DataFrame,
    zone: str = "UTC",
    bounds: DigestBounds | None = None,
    days: DataFrame | None = None,
) -> DataFrame:
    """One Markdown document per day, with the counts and hash of ``digest_summary``."""
    chosen = selected_days(digest_items(records, bounds), with_blocks=True)
    document = F.concat(
        F.lit("# "), F.col("day").cast("string"), F.lit(f" in {zone}\n\n"),
        F.coalesce("blocks", F.lit("")),
        F.lit("---\n\nShown "), F.col("records").cast("string"),
        F.lit(", left out "), F.col("omitted").cast("string"),
        F.lit(", selection "), F.col("selection_sha256"), F.lit("\n"),
    )
    return _with_omitted(records, chosen, days).select("day", document.alias("document"))


def write_digests(documents: DataFrame, path: str) -> None:
    """Write one folder per day; days not in ``documents`` stay as they are."""
    (
        documents.select("day", F.regexp_replace("document", r"\n\z", "").alias("value"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .text(path)
    )


def late_arrivals(records: DataFrame, accounted: DataFrame, closed_days: DataFrame) -> DataFrame:
    """Unaccounted records of days that already have applied batches.

    There is no watermark: a late record stays eligible, and its day is
    rendered again.
    """
    pending = records.join(accounted.select("day", "record_id"), ["day", "record_id"], "left_anti")
    return pending.join(closed_days.select("day").distinct(), "day", "left_semi")


def changed_days(records: DataFrame, since: int) -> DataFrame:
    """(day, late_records): days that runs after ``since`` added records to."""
    added = records.where(F.col("run") > since)
    return added.groupBy("day").agg(F.count("*").alias("late_records"))


def archive_candidates(digests: DataFrame, today: Column, keep_days: int) -> DataFrame:
    """Digests older than ``keep_days``, with the year and month they are kept under."""
    if keep_days < 0:
        raise ValueError("keep_days must not be negative")
    return (
        digests.where(F.col("day") < F.date_sub(today, keep_days))
        .withColumn("year", F.date_format("day", "yyyy"))
        .withColumn("month", F.date_format("day", "MM"))
    )
