"""Bounded, content-addressed packets of unaccounted records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.bounds import MAX_BATCHES_PER_RUN, PacketBounds
from ledgerloom.functions import ident, set_digest, text
from ledgerloom.functions.once import with_once
from ledgerloom.operators import batching
from ledgerloom.operators.daily import DAILY_ORDER
from ledgerloom.operators.groups import budgeted_prefix, next_fit

DAILY_STAGE = "ledger_to_daily"
DOCUMENT_STAGE = "daily_to_documents"

# Sorted ids are hashed per four-digit id prefix first, so no list of all ids of
# a day is ever gathered: a day of 10^10 ids gives lists of about 150,000.
CHECKPOINT_PREFIX = 4


def pending(records: DataFrame, accounted: DataFrame, id_column: str = "record_id") -> DataFrame:
    """Records of a lane that no applied batch accounts for yet."""
    done = accounted.select("day", F.col("id").alias(id_column))
    return records.join(done, ["day", id_column], "left_anti")


def packet_text(value: Column, max_bytes: int) -> Column:
    """Bounded text with the flag that says whether it was cut."""
    if max_bytes < 32:
        raise ValueError("the item bound must be at least 32 bytes")
    return F.struct(
        text.truncate_utf8(value, max_bytes).alias("text"),
        (F.octet_length(value) > max_bytes).alias("truncated"),
    )


def _bound_items(admitted: DataFrame) -> DataFrame:
    return (
        admitted.withColumn("packet_text_sha256", ident.sha256_hex(F.col("bounded")))
        .withColumn("truncated", F.col("packet_text_sha256") != F.col("source_text_sha256"))
        .withColumnRenamed("bounded", "packet_text")
        .withColumnRenamed("bounded_bytes", "packet_bytes")
    )


def packet_items(
    available: DataFrame,
    bounds: PacketBounds | None = None,
    order: Sequence[str] = DAILY_ORDER,
    records: DataFrame | None = None,
) -> DataFrame:
    """Items of the next packet of every day.

    ``available`` holds (day, ids, order columns, text, source_text_sha256). With ``records``,
    which hold the same rows and others, texts are read from there, and ``available`` is asked for keys alone.
    """
    bounds = bounds or PacketBounds()
    admitted = budgeted_prefix(
        available,
        ["day"],
        order,
        lambda body: text.truncate_utf8(body, bounds.item_bytes),
        bounds.max_items,
        bounds.total_bytes,
        texts=records,
    )
    return _bound_items(admitted.drop("text"))


def batched_items(
    available: DataFrame,
    bounds: PacketBounds | None = None,
    max_batches: int = MAX_BATCHES_PER_RUN,
    order: Sequence[str] = DAILY_ORDER,
    records: DataFrame | None = None,
) -> DataFrame:
    """Items of the next ``max_batches`` packets of every day; ``records`` as in ``packet_items``."""
    if not 1 <= max_batches <= MAX_BATCHES_PER_RUN:
        raise ValueError(f"max_batches must be between 1 and {MAX_BATCHES_PER_RUN}")
    bounds = bounds or PacketBounds()
    batched = next_fit(
        available,
        ["day"],
        order,
        lambda body: text.truncate_utf8(body, bounds.item_bytes),
        bounds.max_items,
        bounds.total_bytes,
        max_batches,
        texts=records,
    )
    return _bound_items(batched)


def all_batched_items(
    available: DataFrame,
    bounds: PacketBounds | None = None,
    order: Sequence[str] = DAILY_ORDER,
    records: DataFrame | None = None,
    block_rows: int = batching.BLOCK_ROWS,
) -> DataFrame:
    """Items of all packets of every day, however many a day has; ``records`` as in ``packet_items``.

    Batches are found on the sizes of the items alone; the texts meet them by key once, at the end.
    """
    bounds = bounds or PacketBounds()
    keys = ["day", *order]

    def bound(body: Column) -> Column:
        return text.truncate_utf8(body, bounds.item_bytes)

    placed = batching.whole_batches(
        available, ["day"], order, bound, bounds.max_items, bounds.total_bytes, block_rows=block_rows
    ).select(*keys, "seq", "batch_no", "item_no")
    rows = (available if records is None else records).join(placed, keys)
    cut = text.truncate_utf8(F.col("_bound"), bounds.total_bytes)
    whole = (
        with_once(rows, _bound=bound(F.col("text")))
        .withColumn("bounded", F.when(F.col("item_no") == 1, cut).otherwise(F.col("_bound")))
        .withColumn("bounded_bytes", F.octet_length("bounded").cast("bigint"))
    )
    return _bound_items(whole.drop("_bound", "text"))


def checkpoint_sha256(timezone: Column, accounted: Column, batches: Column) -> Column:
    return ident.digest(
        {"accounted_sha256": accounted, "applied_batches": batches, "timezone": timezone}
    )


def empty_checkpoint_sha256(timezone: Column) -> Column:
    nothing = ident.sha256_hex(F.lit("")), F.array().cast("array<string>")
    return checkpoint_sha256(timezone, *nothing)


def cursor_checkpoints(accounted: DataFrame, batches: DataFrame, zone: str = "UTC") -> DataFrame:
    """Hash of the cursor of every lane and day.

    It changes with the set of accounted ids and with the order of the applied
    batches, of which a day has at most a bounded number.
    """
    prefix = F.substring("id", 1, CHECKPOINT_PREFIX)
    per_prefix = accounted.groupBy("lane", "day", prefix.alias("prefix")).agg(
        F.count("*").alias("ids"),
        ident.sha256_hex(F.array_join(F.array_sort(F.collect_list("id")), "\n")).alias("sha256"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("prefix", "sha256")))
    roots = per_prefix.groupBy("lane", "day").agg(
        F.sum("ids").alias("accounted"),
        ident.sha256_hex(F.array_join(F.transform(ordered, lambda p: p["sha256"]), "\n")).alias(
            "accounted_sha256"
        ),
    )
    return _checkpoints(roots, batches, zone)


def cursors_of_digests(digests: DataFrame, batches: DataFrame, zone: str = "UTC") -> DataFrame:
    """Hash of the cursor of every lane and day from stored sums (lane, day, members, lanes) of the accounted ids.

    It costs what runs stored, a row for each of their days, and not the ids.
    """
    roots = set_digest.combined(digests, ["lane", "day"]).select(
        "lane",
        "day",
        F.col("members").alias("accounted"),
        set_digest.digest(F.col("members"), F.col("lanes")).alias("accounted_sha256"),
    )
    return _checkpoints(roots, batches, zone)


def _checkpoints(roots: DataFrame, batches: DataFrame, zone: str) -> DataFrame:
    in_order = F.array_sort(F.collect_list(F.struct("batch_seq", "batch_id")))
    applied = batches.groupBy("lane", "day").agg(
        F.transform(in_order, lambda b: b["batch_id"]).alias("applied_batches")
    )
    nothing = F.array().cast("array<string>")
    return (
        roots.join(applied, ["lane", "day"], "full")
        .withColumn("accounted", F.coalesce("accounted", F.lit(0).cast("bigint")))
        .withColumn("applied_batches", F.coalesce("applied_batches", nothing))
        .withColumn(
            "checkpoint_sha256",
            checkpoint_sha256(
                F.lit(zone),
                F.coalesce("accounted_sha256", ident.sha256_hex(F.lit(""))),
                F.col("applied_batches"),
            ),
        )
        .select("lane", "day", "accounted", "applied_batches", "checkpoint_sha256")
    )


def build_packets(
    items: DataFrame,
    available: DataFrame,
    cursors: DataFrame,
    stage: str,
    source_version: str | DataFrame,
    zone: str = "UTC",
    bounds: PacketBounds | None = None,
    item_fields: Sequence[str] = (
        "record_id",
        "captured_at",
        "role",
        "source_text_sha256",
        "packet_text_sha256",
        "truncated",
    ),
) -> DataFrame:
    """One row per day with its items nested and ``packet_sha256`` over all of it.

    Items are bound through the hashes of their texts. A day has at most
    ``max_items`` of them; what is left of ``available`` is counted as not yet
    admitted. ``source_version`` names the state the items come
    from, for all days or per day as (day, source_version).
    """
    bounds = bounds or PacketBounds()
    nested = F.array_sort(F.collect_list(F.struct("seq", "packet_text", "packet_bytes", *item_fields)))
    grouped = items.groupBy("day").agg(nested.alias("items"))
    bare = F.transform("items", lambda i: F.struct(*[i[n].alias(n) for n in sorted(item_fields)]))
    packet = {
        "admission_cursor": F.col("cursor_sha256"),
        "bounds": F.struct(
            F.lit(bounds.item_bytes).alias("item_bytes"),
            F.lit(bounds.max_items).alias("max_items"),
            F.lit(bounds.total_bytes).alias("total_text_bytes"),
        ),
        "date": F.col("day").cast("string"),
        "items": bare,
        "not_yet_admitted_item_count": F.col("not_yet_admitted"),
        "source": F.col("source_version"),
        "stage": F.col("stage"),
        "timezone": F.col("timezone"),
    }
    if isinstance(source_version, str):
        versioned = grouped.withColumn("source_version", F.lit(source_version))
    else:
        versioned = grouped.join(source_version.select("day", "source_version"), "day")
    counts = available.groupBy("day").agg(F.count("*").alias("available"))
    return (
        versioned.join(counts, "day")
        .withColumn("not_yet_admitted", F.col("available") - F.size("items"))
        .drop("available")
        .join(cursors.select("day", F.col("checkpoint_sha256").alias("cursor_sha256")), "day", "left")
        .withColumn("stage", F.lit(stage))
        .withColumn("timezone", F.lit(zone))
        .withColumn(
            "cursor_sha256",
            F.coalesce("cursor_sha256", empty_checkpoint_sha256(F.col("timezone"))),
        )
        .withColumn("packet_sha256", ident.digest(packet))
    )


def exploded_items(packets: DataFrame) -> DataFrame:
    """Items of packets as rows."""
    return packets.select("packet_sha256", "day", F.explode("items").alias("item")).select(
        "packet_sha256", "day", "item.*"
    )


def budget_check(items: DataFrame, key: Sequence[str], bounds: PacketBounds | None = None) -> DataFrame:
    """Per batch: its size against the declared bounds, and repeated ids."""
    bounds = bounds or PacketBounds()
    ok = (
        (F.col("items") <= bounds.max_items)
        & (F.col("max_item_bytes") <= bounds.item_bytes)
        & (F.col("total_bytes") <= bounds.total_bytes)
    )
    return (
        items.groupBy(*key)
        .agg(
            F.count("*").alias("items"),
            F.max("packet_bytes").alias("max_item_bytes"),
            F.sum("packet_bytes").alias("total_bytes"),
        )
        .withColumn("within_bounds", ok)
    )


def rebind_failures(items: DataFrame, ledger: DataFrame) -> DataFrame:
    """Packet items that the current ledger lacks or holds with another text."""
    current = ledger.select("record_id", F.col("text_sha256").alias("ledger_text_sha256"))
    return (
        items.join(current, "record_id", "left")
        .withColumn(
            "problem",
            F.when(F.col("ledger_text_sha256").isNull(), "missing").when(
                F.col("ledger_text_sha256") != F.col("source_text_sha256"), "changed"
            ),
        )
        .where(F.col("problem").isNotNull())
    )


def stale_packets(packets: DataFrame, cursors: DataFrame) -> DataFrame:
    """Packets prepared against another cursor than the current one.

    Packets whose batch is in place are left out by the caller: applying them
    again changes nothing.
    """
    now = cursors.select("day", F.col("checkpoint_sha256").alias("current_sha256"))
    return (
        packets.join(now, "day", "left")
        .withColumn(
            "current_sha256",
            F.coalesce("current_sha256", empty_checkpoint_sha256(F.col("timezone"))),
        )
        .where(F.col("current_sha256") != F.col("cursor_sha256"))
    )
