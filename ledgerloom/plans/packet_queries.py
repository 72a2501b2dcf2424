"""Cursors, packets and batching over the sample ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.bounds import PacketBounds
from ledgerloom.functions import ident
from ledgerloom.operators import apply, packets
from ledgerloom.plans import oracle_ctes as o
from ledgerloom.plans.daily_queries import daily_records
from ledgerloom.plans.registry import query
from ledgerloom.plans.sample_tables import ZONE, stored_once

BOUNDS = PacketBounds(max_items=60, item_bytes=600, total_bytes=16_000)
LANE = "daily"
SOURCE_VERSION = "sample-ledger"


def available_records(spark: SparkSession, sf: str) -> DataFrame:
    """Dated records in the shape packets are built from."""
    return daily_records(spark, sf).select(
        "day", "record_id", "captured_at", "role", "text", F.col("text_sha256").alias("source_text_sha256")
    )


def morning(records: DataFrame) -> DataFrame:
    """Records an earlier run of the day accounted for: those before 06:00 UTC."""
    return records.where(F.substring("captured_at", 12, 2) < "06")


def accounted_ids(records: DataFrame) -> DataFrame:
    return morning(records).select(F.lit(LANE).alias("lane"), "day", F.col("record_id").alias("id"))


def applied_batches(records: DataFrame) -> DataFrame:
    """Two applied batches for every day that has a morning run."""
    days = morning(records).select("day").distinct()
    numbered = days.select("day", F.explode(F.array(F.lit(1), F.lit(2))).alias("batch_seq"))
    return numbered.select(
        F.lit(LANE).alias("lane"),
        "day",
        "batch_seq",
        F.sha2(F.concat_ws("#", F.col("day").cast("string"), F.col("batch_seq").cast("string")), 256).alias("batch_id"),
    )


PENDING_SQL = o.DAILY + """,
morning AS (SELECT * FROM daily WHERE substr(captured_at, 12, 2) < '06'),
pending AS (SELECT * FROM daily WHERE record_id NOT IN (SELECT record_id FROM morning)),
prefixes AS (SELECT day, left(record_id, 4) AS prefix, count(*) AS ids,
  sha256(string_agg(record_id, chr(10) ORDER BY record_id)) AS sha256 FROM morning GROUP BY ALL),
roots AS (SELECT day, CAST(sum(ids) AS BIGINT) AS accounted,
  sha256(string_agg(sha256, chr(10) ORDER BY prefix)) AS accounted_sha256 FROM prefixes GROUP BY day),
cursors AS (SELECT day, accounted, sha256(day || '#1') || ',' || sha256(day || '#2') AS applied_batches,
  sha256('{"accounted_sha256":"' || accounted_sha256 || '","applied_batches":["' || sha256(day || '#1') || '","'
    || sha256(day || '#2') || '"],"timezone":"Asia/Seoul"}') AS checkpoint_sha256 FROM roots)
"""

_ITEMS = PENDING_SQL + f""",
bound AS (SELECT *, {o.truncated('text', 600)} AS packet_text,
  row_number() OVER (PARTITION BY day ORDER BY captured_at, record_id) AS seq FROM pending),
sized AS (SELECT *, strlen(packet_text) AS bytes, sum(strlen(packet_text)) OVER (PARTITION BY day ORDER BY seq) AS used
  FROM bound WHERE seq <= 60),
items AS (SELECT *, sha256(packet_text) AS packet_text_sha256, packet_text <> text AS truncated
  FROM sized WHERE used <= 16000)
"""


def sample_packets(spark: SparkSession, sf: str) -> DataFrame:
    """The stored packets of ``built_packets``: a packet is frozen before it is decided on."""
    return stored_once("packets", spark, sf, lambda: built_packets(spark, sf))


def built_packets(spark: SparkSession, sf: str) -> DataFrame:
    """The next packet of every day after the morning run."""
    records = available_records(spark, sf)
    accounted = accounted_ids(records)
    available = packets.pending(records, accounted)
    items = packets.packet_items(available, BOUNDS)
    cursors = packets.cursor_checkpoints(accounted, applied_batches(records), ZONE)
    return packets.build_packets(
        items, available, cursors, packets.DAILY_STAGE, SOURCE_VERSION, ZONE, BOUNDS
    )


@query("admission_pending", o.with_(PENDING_SQL, "SELECT day, record_id FROM pending"))
def admission_pending(spark: SparkSession, sf: str) -> DataFrame:
    records = available_records(spark, sf).select("day", "record_id", "captured_at")
    return packets.pending(records, accounted_ids(records)).select("day", "record_id")


@query(
    "cursor_checkpoint",
    o.with_(PENDING_SQL, "SELECT day, accounted, applied_batches, checkpoint_sha256 FROM cursors"),
)
def cursor_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    records = available_records(spark, sf).select("day", "record_id", "captured_at")
    cursors = packets.cursor_checkpoints(accounted_ids(records), applied_batches(records), ZONE)
    return cursors.drop("lane").withColumn("applied_batches", F.array_join("applied_batches", ","))


@query(
    "cursor_advance",
    o.with_(
        _ITEMS,
        """SELECT 'daily' AS lane, day, record_id AS id FROM morning
           UNION SELECT 'daily', day, record_id FROM items""",
    ),
)
def cursor_advance(spark: SparkSession, sf: str) -> DataFrame:
    """Accounted ids after the next packets; the packets repeat no accounted id."""
    records = available_records(spark, sf)
    accounted = accounted_ids(records)
    items = packets.packet_items(packets.pending(records, accounted), BOUNDS)
    admitted = items.select(F.lit(LANE).alias("lane"), "day", F.col("record_id").alias("id"))
    return apply.advance_cursor(accounted, admitted.unionByName(accounted))


_PACKETS = _ITEMS + """,
packet_bodies AS (
  SELECT day, any_value(left_over) AS not_yet_admitted, count(*) AS items, sum(bytes) AS total_bytes,
    '{"admission_cursor":"' || coalesce(any_value(checkpoint_sha256), sha256('{"accounted_sha256":"'
      || sha256('') || '","applied_batches":[],"timezone":"Asia/Seoul"}'))
    || '","bounds":{"item_bytes":600,"max_items":60,"total_text_bytes":16000},"date":"' || day || '","items":['
    || string_agg('{"captured_at":"' || captured_at || '","packet_text_sha256":"' || packet_text_sha256
       || '","record_id":"' || record_id || '","role":"' || role || '","source_text_sha256":"' || text_sha256
       || '","truncated":' || truncated || '}', ',' ORDER BY seq)
    || '],"not_yet_admitted_item_count":' || any_value(left_over)
    || ',"source":"sample-ledger","stage":"ledger_to_daily","timezone":"Asia/Seoul"}' AS body
  FROM items LEFT JOIN cursors USING (day)
  JOIN (SELECT day, (SELECT count(*) FROM pending p WHERE p.day = d.day)
          - (SELECT count(*) FROM items i WHERE i.day = d.day) AS left_over
        FROM (SELECT DISTINCT day FROM pending) d) USING (day)
  GROUP BY day),
packets AS (SELECT *, sha256(body) AS packet_sha256 FROM packet_bodies)
"""


@query(
    "packet_build",
    o.with_(
        _PACKETS,
        """SELECT day, packet_sha256, items, CAST(not_yet_admitted AS BIGINT) AS not_yet_admitted FROM packets""",
    ),
)
def packet_build(spark: SparkSession, sf: str) -> DataFrame:
    return built_packets(spark, sf).select(
        "day", "packet_sha256", F.size("items").cast("bigint").alias("items"), "not_yet_admitted"
    )


@query(
    "packet_budget_check",
    o.with_(
        _PACKETS,
        """SELECT packet_sha256, CAST(bound AS BIGINT) AS limit_bytes, items, max_item_bytes, total_bytes,
           total_bytes <= bound AS within_bounds
           FROM (SELECT p.packet_sha256, count(*) AS items, CAST(max(bytes) AS BIGINT) AS max_item_bytes,
                 CAST(sum(bytes) AS BIGINT) AS total_bytes FROM items JOIN packets p USING (day) GROUP BY 1),
           (VALUES (12000), (16000)) AS l(bound)""",
    ),
)
def packet_budget_check(spark: SparkSession, sf: str) -> DataFrame:
    """Packets against a smaller total than they were built with, and against their own."""
    rows = packets.exploded_items(sample_packets(spark, sf))

    def checked(total: int) -> DataFrame:
        bounds = PacketBounds(BOUNDS.max_items, BOUNDS.item_bytes, total)
        found = packets.budget_check(rows, ["packet_sha256"], bounds)
        return found.select(
            "packet_sha256", F.lit(total).cast("bigint").alias("limit_bytes"), "items", "max_item_bytes",
            "total_bytes", "within_bounds",
        )

    return checked(12_000).unionByName(checked(BOUNDS.total_bytes))


@query(
    "packet_rebind",
    o.with_(
        _PACKETS,
        """SELECT p.packet_sha256, record_id, CASE WHEN role = 'user' THEN 'missing' ELSE 'changed' END AS problem
           FROM items JOIN packets p USING (day) WHERE role = 'user' OR length(text) > 600""",
    ),
)
def packet_rebind(spark: SparkSession, sf: str) -> DataFrame:
    """Packet items against a ledger without user records and with shorter assistant texts."""
    current = daily_records(spark, sf).where(F.col("role") == "assistant")
    shorter = current.select("record_id", F.sha2(F.substring("text", 1, 600), 256).alias("text_sha256"))
    rows = packets.exploded_items(sample_packets(spark, sf))
    return packets.rebind_failures(rows, shorter).select("packet_sha256", "record_id", "problem")


@query(
    "stale_cursor",
    o.with_(
        _PACKETS,
        """SELECT day, packet_sha256 FROM packets WHERE day IN (SELECT day FROM morning)
           AND day <> (SELECT min(day) FROM morning)""",
    ),
)
def stale_cursor(spark: SparkSession, sf: str) -> DataFrame:
    """Packets after another batch was applied to every day; the first day's packet is that batch."""
    records = available_records(spark, sf)
    named = ident.batch_id(F.col("packet_sha256"), F.lit("result"))
    built = sample_packets(spark, sf).withColumn("batch_id", named)
    before = applied_batches(records)
    more = before.where(F.col("batch_seq") == 2).select(
        "lane", "day", F.lit(3).alias("batch_seq"), F.sha2("batch_id", 256).alias("batch_id")
    )
    now = packets.cursor_checkpoints(accounted_ids(records), before.unionByName(more), ZONE)
    first_day = before.agg(F.min("day")).scalar()
    todo = apply.unapplied(built, built.where(F.col("day") == first_day))
    return packets.stale_packets(todo, now).select("day", "packet_sha256")


NEXT_FIT = PENDING_SQL + f""",
bound AS (SELECT day, record_id, text, {o.truncated('text', 600)} AS bounded,
  row_number() OVER (PARTITION BY day ORDER BY captured_at, record_id) AS seq FROM daily),
sized AS (SELECT day, record_id, seq, strlen(bounded) AS bytes FROM bound),
walk AS (
  SELECT day, seq, record_id, bytes, 1 AS batch_no, 1 AS item_no, bytes AS used FROM sized WHERE seq = 1
  UNION ALL
  SELECT s.day, s.seq, s.record_id, s.bytes,
    CASE WHEN w.item_no >= 60 OR w.used + s.bytes > 16000 THEN w.batch_no + 1 ELSE w.batch_no END,
    CASE WHEN w.item_no >= 60 OR w.used + s.bytes > 16000 THEN 1 ELSE w.item_no + 1 END,
    CASE WHEN w.item_no >= 60 OR w.used + s.bytes > 16000 THEN s.bytes ELSE w.used + s.bytes END
  FROM walk w JOIN sized s ON s.day = w.day AND s.seq = w.seq + 1)
"""


@query(
    "next_fit_batches",
    o.with_(
        NEXT_FIT,
        """SELECT day, record_id, CAST(batch_no AS BIGINT) AS batch_no, CAST(item_no AS BIGINT) AS item_no,
           CAST(bytes AS BIGINT) AS packet_bytes FROM walk WHERE batch_no <= 32""",
        recursive=True,
    ),
)
def next_fit_batches(spark: SparkSession, sf: str) -> DataFrame:
    """All batches of one run, 32 a day at most."""
    batched = packets.batched_items(available_records(spark, sf), BOUNDS)
    return batched.select(
        "day",
        "record_id",
        F.col("batch_no").cast("bigint").alias("batch_no"),
        F.col("item_no").cast("bigint").alias("item_no"),
        "packet_bytes",
    )
