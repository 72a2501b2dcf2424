"""Daily selection, digests and retention over the sample tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import daily
from ledgerloom.plans import oracle_ctes as o
from ledgerloom.plans.registry import query
from ledgerloom.plans.sample_tables import ZONE, sample_ledger
from ledgerloom.session import work_folder


def daily_records(spark: SparkSession, sf: str) -> DataFrame:
    return daily.with_local_day(sample_ledger(spark, sf), ZONE)


_SUMMARY_SQL = """
SELECT d.day, CAST(count(i.record_id) AS BIGINT) AS records,
       CAST(any_value(a.n) - count(i.record_id) AS BIGINT) AS omitted,
       CAST(coalesce(sum(strlen(i.excerpt)), 0) AS BIGINT) AS excerpt_bytes,
       sha256('[' || string_agg('{"record_id":"' || i.record_id || '","text_sha256":"' || i.text_sha256
         || '"}', ',' ORDER BY i.seq) || ']') AS selection_sha256
FROM (SELECT DISTINCT day FROM daily) d
JOIN (SELECT day, count(*) AS n FROM daily GROUP BY day) a USING (day)
LEFT JOIN digest_items i USING (day)
GROUP BY d.day
"""


@query("daily_digest_summary", o.with_(o.DIGEST, _SUMMARY_SQL))
def daily_digest_summary(spark: SparkSession, sf: str) -> DataFrame:
    return daily.digest_summary(daily_records(spark, sf))


@query(
    "daily_select",
    o.with_(o.DAILY, "SELECT day, record_id, captured_at FROM daily WHERE day = DATE '2024-01-02'"),
)
def daily_select(spark: SparkSession, sf: str) -> DataFrame:
    """Records of one local day from a ledger that is stored by UTC day."""
    return daily.select_day(sample_ledger(spark, sf), "2024-01-02", ZONE).select("day", "record_id", "captured_at")


@query(
    "daily_order",
    o.with_(
        o.DAILY,
        """SELECT day, record_id, row_number() OVER (PARTITION BY day ORDER BY captured_at, record_id) AS seq
           FROM daily""",
    ),
)
def daily_order(spark: SparkSession, sf: str) -> DataFrame:
    records = daily_records(spark, sf).select("day", "captured_at", "record_id")
    ordered = daily.daily_order(records, work_folder(spark) + "/ordered")
    return ordered.select("day", "record_id", "seq")


@query(
    "budgeted_prefix",
    o.with_(
        o.DIGEST,
        """SELECT day, CAST(seq AS BIGINT) AS seq, record_id, role, excerpt,
           CAST(strlen(excerpt) AS BIGINT) AS excerpt_bytes FROM digest_items""",
    ),
)
def budgeted_prefix(spark: SparkSession, sf: str) -> DataFrame:
    items = daily.digest_items(daily_records(spark, sf))
    return items.select(
        "day", F.col("seq").cast("bigint").alias("seq"), "record_id", "role", "excerpt", "excerpt_bytes"
    )


@query(
    "selection_hash",
    o.with_(o.DIGEST, f"SELECT day, records, selection_sha256 FROM ({_SUMMARY_SQL})"),
)
def selection_hash(spark: SparkSession, sf: str) -> DataFrame:
    hashes = daily.selected_days(daily.digest_items(daily_records(spark, sf)))
    return hashes.select("day", "records", "selection_sha256")


@query("omitted_counts", o.with_(o.DIGEST, f"SELECT day, records, omitted FROM ({_SUMMARY_SQL})"))
def omitted_counts(spark: SparkSession, sf: str) -> DataFrame:
    summary = daily.digest_summary(daily_records(spark, sf))
    return summary.select("day", "records", "omitted")


_RENDER_SQL = """
SELECT day, '# ' || day || ' in Asia/Seoul' || chr(10) || chr(10)
  || string_agg('**' || seq || '** ' || role || ' · ' || left(record_id, 12) || ' · ' || source_ref || ' @ '
     || byte_start || ' + ' || (byte_end - byte_start) || ' · ' || left(text_sha256, 12) || chr(10) || chr(10)
     || '> ' || excerpt || chr(10) || chr(10), '' ORDER BY seq)
  || '---' || chr(10) || chr(10) || 'Shown ' || any_value(records) || ', left out ' || any_value(omitted)
  || ', selection ' || any_value(selection_sha256) || chr(10) AS document
FROM digest_items JOIN (""" + _SUMMARY_SQL + """) USING (day) GROUP BY day
"""


@query("digest_render", o.with_(o.DIGEST, _RENDER_SQL))
def digest_render(spark: SparkSession, sf: str) -> DataFrame:
    return daily.digest_documents(daily_records(spark, sf), ZONE)


@query(
    "archive_candidates",
    o.with_(
        o.DAILY,
        """SELECT day, strftime(day, '%Y') AS year, strftime(day, '%m') AS month, count(*) AS records
           FROM daily WHERE day < (SELECT max(day) FROM daily) - 1 GROUP BY day""",
    ),
)
def archive_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Days to archive one day after the newest day of the ledger."""
    days = daily_records(spark, sf).groupBy("day").agg(F.count("*").alias("records"))
    newest = days.agg(F.max("day")).scalar()
    return daily.archive_candidates(days, newest, 1).select("day", "year", "month", "records")


@query(
    "late_arrivals",
    o.with_(
        o.DAILY,
        """SELECT day, record_id FROM daily WHERE role = 'assistant'
           AND day IN (SELECT day FROM daily WHERE role = 'user')""",
    ),
)
def late_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """Assistant records that come in after the user records of their day were applied."""
    records = daily_records(spark, sf).select("day", "record_id", "role")
    accounted = records.where(F.col("role") == "user")
    return daily.late_arrivals(records, accounted, accounted).select("day", "record_id")
