"""Daily decisions, batches and commits over the sample packets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions import ident, text
from ledgerloom.operators import apply, decisions, packets
from ledgerloom.plans import oracle_ctes as o
from ledgerloom.plans.packet_queries import BOUNDS, NEXT_FIT, available_records
from ledgerloom.plans.registry import query
from ledgerloom.plans.sample_tables import ZONE, stored_once

ENTRY_SOURCES = 3


def decision_items(spark: SparkSession, sf: str) -> DataFrame:
    """The stored items of all batches of one run, with a packet hash per batch."""
    return stored_once("batched_items", spark, sf, lambda: _batched(spark, sf))


def _batched(spark: SparkSession, sf: str) -> DataFrame:
    batched = packets.batched_items(available_records(spark, sf), BOUNDS)
    packet = F.concat_ws("#", F.lit("packet"), F.col("day").cast("string"), F.col("batch_no").cast("string"))
    return batched.withColumn("packet_sha256", ident.sha256_hex(packet)).withColumnRenamed("record_id", "item_id")


def entries_of(items: DataFrame) -> DataFrame:
    """Included items, three to an entry; a packet holds a bounded number of them."""
    in_packet = Window.partitionBy("packet_sha256").orderBy("item_no")
    grouped = (
        items.withColumn("rank", F.row_number().over(in_packet))
        .withColumn("entry_no", F.ceil(F.col("rank") / ENTRY_SOURCES).cast("int"))
        .groupBy("packet_sha256", "entry_no")
        .agg(F.array_sort(F.collect_list(F.struct("item_no", "item_id", "packet_text"))).alias("rows"))
    )
    first = F.element_at("rows", 1)["packet_text"]
    return grouped.select(
        "packet_sha256",
        "entry_no",
        F.transform("rows", lambda row: row["item_id"]).alias("source_record_ids"),
        text.truncate_utf8(text.collapse_whitespace(first), 300).alias("summary"),
    )


def is_included() -> Column:
    return F.col("packet_bytes") >= 200


def good_decisions(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Short items are omitted, the others summarised."""
    omitted = items.where(~is_included()).select(
        "packet_sha256", F.col("item_id").alias("record_id"), F.lit("low_signal").alias("reason")
    )
    return entries_of(items.where(is_included())), omitted


def faulty_decisions(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Decisions that forget the second item, repeat the first and name an unknown one."""
    entries, omitted = good_decisions(items.where(F.col("item_no") != 2))
    repeated = items.where(F.col("item_no") == 1).select(
        "packet_sha256", F.col("item_id").alias("record_id"), F.lit("redundant").alias("reason")
    )
    unknown = items.select("packet_sha256").distinct().select(
        "packet_sha256",
        ident.sha256_hex(F.concat(F.lit("unknown#"), "packet_sha256")).alias("record_id"),
        F.lit("other").alias("reason"),
    )
    marked = F.when(F.col("entry_no") == 1, F.concat(F.lit("\u200b"), "summary")).otherwise(F.col("summary"))
    return entries.withColumn("summary", marked), omitted.unionByName(repeated).unionByName(unknown)


_SUMMARY = o.truncated("line1", 300)


def _decision_ctes(included_where: str, prefix: str) -> str:
    return f"""
{prefix}included AS (SELECT *, (row_number() OVER (PARTITION BY packet_sha256 ORDER BY item_no) - 1) // 3 + 1 AS entry_no
  FROM ditems WHERE bytes >= 200 AND {included_where}),
{prefix}grouped AS (SELECT packet_sha256, entry_no, list(item_id ORDER BY item_no) AS ids,
    {o.one_line('first(packet_text ORDER BY item_no)')} AS line1 FROM {prefix}included GROUP BY 1, 2),
{prefix}entries AS (SELECT packet_sha256, entry_no, ids, {_SUMMARY} AS summary FROM {prefix}grouped),
{prefix}omitted AS (SELECT packet_sha256, item_id AS record_id, 'low_signal' AS reason FROM ditems
  WHERE bytes < 200 AND {included_where})"""


_ITEMS = NEXT_FIT + """,
ditems AS (SELECT w.day, w.batch_no, w.item_no, w.record_id AS item_id, w.bytes, b.bounded AS packet_text,
    sha256('packet#' || w.day || '#' || w.batch_no) AS packet_sha256
  FROM walk w JOIN bound b USING (record_id) WHERE w.batch_no <= 32)"""

_GOOD = _ITEMS + "," + _decision_ctes("true", "")

_FAULTY = _ITEMS + "," + _decision_ctes("item_no <> 2", "f") + """,
faulty_entries AS (SELECT packet_sha256, entry_no, ids,
    CASE WHEN entry_no = 1 THEN chr(8203) || summary ELSE summary END AS summary FROM fentries),
faulty_omitted AS (SELECT * FROM fomitted
  UNION ALL SELECT packet_sha256, item_id, 'redundant' FROM ditems WHERE item_no = 1
  UNION ALL SELECT DISTINCT packet_sha256, sha256('unknown#' || packet_sha256), 'other' FROM ditems),
uses AS (SELECT packet_sha256, item_id, count(*) AS uses FROM (
    SELECT packet_sha256, unnest(ids) AS item_id FROM faulty_entries
    UNION ALL SELECT packet_sha256, record_id FROM faulty_omitted) GROUP BY 1, 2),
coverage AS (SELECT coalesce(d.packet_sha256, u.packet_sha256) AS packet_sha256,
    coalesce(d.item_id, u.item_id) AS item_id, coalesce(u.uses, 0) AS uses,
    CASE WHEN d.item_id IS NULL THEN 'unknown' WHEN u.uses IS NULL THEN 'missing'
         WHEN u.uses > 1 THEN 'repeated' ELSE 'ok' END AS status
  FROM ditems d FULL JOIN uses u ON d.packet_sha256 = u.packet_sha256 AND d.item_id = u.item_id)
"""


@query(
    "decision_coverage",
    o.with_(_FAULTY, "SELECT packet_sha256, item_id, uses, status FROM coverage", recursive=True),
)
def decision_coverage(spark: SparkSession, sf: str) -> DataFrame:
    items = decision_items(spark, sf)
    return decisions.coverage(items, decisions.daily_assignments(*faulty_decisions(items)))


@query(
    "validate_daily",
    o.with_(
        _FAULTY,
        f"""SELECT packet_sha256, 'coverage_' || status AS rule, item_id AS subject FROM coverage WHERE status <> 'ok'
           UNION ALL SELECT packet_sha256, 'entry_summary', entry_no::VARCHAR FROM faulty_entries
             WHERE {o.strip('summary')} = '' OR nfc_normalize(summary) <> summary OR strlen(summary) > 1200
                OR regexp_matches(summary, '{o.FORBIDDEN}')
           UNION ALL SELECT packet_sha256, 'omission_reason', record_id FROM faulty_omitted
             WHERE reason NOT IN ('low_signal', 'redundant', 'sensitive', 'unsupported')
           UNION ALL SELECT packet_sha256, 'entry_source_count', entry_no::VARCHAR FROM faulty_entries
             WHERE len(ids) NOT BETWEEN 1 AND 12
           UNION ALL SELECT packet_sha256, 'entry_count', count(*)::VARCHAR FROM faulty_entries
             GROUP BY packet_sha256 HAVING count(*) > 40""",
        recursive=True,
    ),
)
def validate_daily(spark: SparkSession, sf: str) -> DataFrame:
    items = decision_items(spark, sf)
    return decisions.validate_daily(items, *faulty_decisions(items))


def producers_of(items: DataFrame) -> DataFrame:
    """A producer a packet; some have none or two, or lack a name, and one is of no packet."""
    found = items.select("packet_sha256").distinct()
    digit = F.substring("packet_sha256", 1, 1)
    rows = (
        found.where(digit != "0")
        .withColumn("copy", F.explode(F.when(digit == "1", F.sequence(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
        .select(
            "packet_sha256",
            F.when(digit == "2", "").otherwise("tool").alias("kind"),
            F.when(digit == "3", "\a").otherwise("1.0").alias("tool_version"),
            F.when(digit == "4", "-model").otherwise("vendor/model-1").alias("model"),
            F.when(digit == "5", "High").otherwise("high").alias("reasoning_effort"),
            F.when(digit == "6", "two\nlines").otherwise("sealed").alias("isolation_profile"),
        )
    )
    stray = found.agg(F.min("packet_sha256").alias("m")).where("m IS NOT NULL")
    return rows.unionByName(
        stray.select(
            ident.sha256_hex(F.lit("no packet")).alias("packet_sha256"),
            F.lit("tool").alias("kind"),
            F.lit("1.0").alias("tool_version"),
            F.lit("vendor/model-1").alias("model"),
            F.lit("high").alias("reasoning_effort"),
            F.lit("sealed").alias("isolation_profile"),
        )
    )


@query(
    "producer_check",
    o.with_(
        _ITEMS + ", p AS (SELECT DISTINCT packet_sha256, left(packet_sha256, 1) AS d FROM ditems)",
        """SELECT packet_sha256, CASE d WHEN '0' THEN 'producer_missing' WHEN '1' THEN 'producer_repeated'
             WHEN '2' THEN 'producer_kind' WHEN '3' THEN 'producer_version' WHEN '4' THEN 'producer_model'
             WHEN '5' THEN 'producer_effort' ELSE 'producer_profile' END AS rule,
             CASE d WHEN '0' THEN '0' WHEN '1' THEN '2' WHEN '4' THEN '-model' ELSE 'vendor/model-1' END AS subject
           FROM p WHERE d BETWEEN '0' AND '6'
           UNION ALL SELECT sha256('no packet'), 'producer_unknown', '1' WHERE EXISTS (SELECT * FROM p)""",
        recursive=True,
    ),
)
def producer_check(spark: SparkSession, sf: str) -> DataFrame:
    """What is wrong with the producers of all packets of one run."""
    items = decision_items(spark, sf)
    producers = producers_of(items)
    return decisions.producer_violations(producers).unionByName(decisions.producer_coverage(items, producers))


_TALLY_SQL = """
SELECT i.packet_sha256, count(*) AS items, any_value(coalesce(e.n, 0)) AS included_entries,
  CAST(any_value(coalesce(e.records, 0)) AS BIGINT) AS included_records,
  any_value(coalesce(x.n, 0)) AS omitted_records,
  (SELECT count(*) FROM daily d WHERE d.day = any_value(i.day))
    - (SELECT count(*) FROM ditems q WHERE q.day = any_value(i.day) AND q.batch_no <= any_value(i.batch_no))
    AS not_yet_admitted
FROM ditems i
LEFT JOIN (SELECT packet_sha256, count(*) AS n, sum(len(ids)) AS records FROM entries GROUP BY 1) e
  ON e.packet_sha256 = i.packet_sha256
LEFT JOIN (SELECT packet_sha256, count(*) AS n FROM omitted GROUP BY 1) x ON x.packet_sha256 = i.packet_sha256
GROUP BY 1
"""


@query("decision_tally", o.with_(_GOOD, _TALLY_SQL, recursive=True))
def decision_tally(spark: SparkSession, sf: str) -> DataFrame:
    """Decisions per packet, and the day's records that it and the packets before it leave."""
    items = decision_items(spark, sf)
    upto = Window.partitionBy("day").orderBy("batch_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    admitted = items.groupBy("packet_sha256", "day", "batch_no").count().withColumn("admitted", F.sum("count").over(upto))
    available = available_records(spark, sf).groupBy("day").agg(F.count("*").alias("available"))
    counts = admitted.join(available, "day").withColumn("not_yet_admitted", F.col("available") - F.col("admitted"))
    return decisions.tally(items, *good_decisions(items), counts)


_IDENTITIES = _GOOD + """,
entry_ids AS (SELECT *, sha256('{"index":' || entry_no || ',"packet_sha256":"' || packet_sha256
    || '","source_record_ids":' || to_json(ids)::VARCHAR || ',"summary":' || to_json(summary)::VARCHAR || '}') AS entry_id
  FROM entries),
results AS (
  SELECT p.packet_sha256, p.day, p.batch_no, sha256(p.packet_sha256 || chr(10)
      || '[' || coalesce(e.body, '') || ']' || chr(10) || '[' || coalesce(x.body, '') || ']') AS result_sha256,
    coalesce(e.n, 0) AS included, coalesce(x.n, 0) AS omitted
  FROM (SELECT DISTINCT packet_sha256, day, batch_no FROM ditems) p
  LEFT JOIN (SELECT packet_sha256, count(*) AS n, string_agg('{"entry_no":' || entry_no || ',"source_record_ids":'
      || to_json(ids)::VARCHAR || ',"summary":' || to_json(summary)::VARCHAR || '}', ',' ORDER BY entry_no) AS body
      FROM entries GROUP BY 1) e ON e.packet_sha256 = p.packet_sha256
  LEFT JOIN (SELECT packet_sha256, count(*) AS n, string_agg('{"record_id":"' || record_id || '","reason":"' || reason
      || '"}', ',' ORDER BY record_id) AS body FROM omitted GROUP BY 1) x ON x.packet_sha256 = p.packet_sha256),
batches AS (SELECT *, sha256('{"packet_sha256":"' || packet_sha256 || '","result_sha256":"' || result_sha256 || '"}')
    AS batch_id FROM results)
"""


def _identity_sql(select: str) -> str:
    return o.with_(_IDENTITIES, select, recursive=True)


def sample_batches(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Batches and identified entries of the good decisions."""
    prepared = (
        items.select("packet_sha256", "day", "batch_no")
        .distinct()
        .withColumn("timezone", F.lit(ZONE))
        .withColumn("not_yet_admitted", F.lit(0).cast("bigint"))
    )
    entries, omitted = good_decisions(items)
    batches = apply.daily_batches(prepared, entries, omitted)
    return batches, apply.daily_entries(batches, entries)


@query("entry_identity", _identity_sql("SELECT packet_sha256, CAST(entry_no AS BIGINT) AS entry_no, entry_id FROM entry_ids"))
def entry_identity(spark: SparkSession, sf: str) -> DataFrame:
    _, entries = sample_batches(decision_items(spark, sf))
    return entries.select("packet_sha256", F.col("entry_no").cast("bigint").alias("entry_no"), "entry_id")


@query("daily_batch_build", _identity_sql("SELECT day, packet_sha256, result_sha256, batch_id, included, omitted FROM batches"))
def daily_batch_build(spark: SparkSession, sf: str) -> DataFrame:
    batches, _ = sample_batches(decision_items(spark, sf))
    return batches.select("day", "packet_sha256", "result_sha256", "batch_id", "included", "omitted")


@query(
    "commit_verify",
    _identity_sql(
        """SELECT batch_id, CASE batch_no WHEN 1 THEN 'changed' WHEN 2 THEN 'missing' ELSE 'ok' END AS outcome
           FROM batches"""
    ),
)
def commit_verify(spark: SparkSession, sf: str) -> DataFrame:
    """Commits against what is there now: first batches edited, second batches gone."""
    batches, entries = sample_batches(decision_items(spark, sf))
    documents = apply.batch_documents(batches, entries)
    committed = apply.commit_rows(batches, documents)
    numbers = batches.select("batch_id", "batch_no")
    edited = (
        documents.join(numbers, "batch_id")
        .where(F.col("batch_no") != 2)
        .withColumn("document", F.when(F.col("batch_no") == 1, F.lower("document")).otherwise(F.col("document")))
    )
    now = apply.commit_rows(batches, edited.drop("batch_no"))
    return apply.verify_commits(committed, now).select("batch_id", "outcome")


@query(
    "write_once_check",
    _identity_sql(
        """SELECT packet_sha256, CASE batch_no WHEN 1 THEN 'conflict' WHEN 2 THEN 'identical' ELSE 'new' END AS status
           FROM batches"""
    ),
)
def write_once_check(spark: SparkSession, sf: str) -> DataFrame:
    """Batches against stored ones: first batches stored with another result, second ones the same."""
    batches, _ = sample_batches(decision_items(spark, sf))
    stored = batches.where(F.col("batch_no") <= 2).select(
        "packet_sha256",
        F.when(F.col("batch_no") == 1, F.sha2("result_sha256", 256)).otherwise(F.col("result_sha256")).alias("result_sha256"),
    )
    return apply.write_once(batches, stored, "packet_sha256", "result_sha256").select("packet_sha256", "status")


@query("idempotent_apply", _identity_sql("SELECT batch_id, packet_sha256 FROM batches WHERE batch_no > 1"))
def idempotent_apply(spark: SparkSession, sf: str) -> DataFrame:
    """What a second run still applies when every day's first batch is in place."""
    batches, _ = sample_batches(decision_items(spark, sf))
    applied = batches.where(F.col("batch_no") == 1)
    return apply.unapplied(batches, applied).select("batch_id", "packet_sha256")


@query(
    "entry_result_lookup",
    _identity_sql("SELECT entry_id, batch_id, result_sha256 FROM entry_ids JOIN batches USING (packet_sha256)"),
)
def entry_result_lookup(spark: SparkSession, sf: str) -> DataFrame:
    batches, entries = sample_batches(decision_items(spark, sf))
    return apply.entries_with_results(entries, batches).select("entry_id", "batch_id", "result_sha256")


@query(
    "provenance_set",
    _identity_sql(
        """SELECT sha256('sweep#' || day) AS packet_sha256, CAST(count(DISTINCT result_sha256) AS BIGINT) AS results,
           string_agg(DISTINCT result_sha256, ',' ORDER BY result_sha256) AS result_sha256s
           FROM entry_ids JOIN batches USING (packet_sha256) GROUP BY day"""
    ),
)
def provenance_set(spark: SparkSession, sf: str) -> DataFrame:
    """Results behind the entries that one sweep per day disposes of."""
    batches, entries = sample_batches(decision_items(spark, sf))
    sweep = ident.sha256_hex(F.concat_ws("#", F.lit("sweep"), F.col("day").cast("string")))
    disposed = apply.entries_with_results(entries, batches).select(
        sweep.alias("packet_sha256"), "entry_id", "result_sha256"
    )
    sets = apply.provenance_sets(disposed)
    return sets.select("packet_sha256", F.col("results").cast("bigint").alias("results"), "result_sha256s")


@query(
    "commit_set_equal",
    _identity_sql(
        """SELECT day, sha256('sweep#' || day) AS packet_sha256, CAST(CASE WHEN day(day) % 2 = 0 THEN count(*)
             ELSE least(count(*), 2) END AS BIGINT) AS frozen_commits,
           count(*) AS current_commits, count(*) <= 2 OR day(day) % 2 = 0 AS unchanged FROM batches GROUP BY day"""
    ),
)
def commit_set_equal(spark: SparkSession, sf: str) -> DataFrame:
    """Sweeps prepared when odd days had two committed batches and even days all of them, against all batches."""
    batches, entries = sample_batches(decision_items(spark, sf))
    commits = apply.commit_rows(batches, apply.batch_documents(batches, entries))
    frozen = commits.join(
        batches.where((F.col("batch_no") <= 2) | (F.dayofmonth("day") % 2 == 0)).select("batch_id"), "batch_id", "left_semi"
    )
    sweeps = apply.commit_lists(frozen).withColumn("packet_sha256", ident.sha256_hex(F.concat_ws("#", F.lit("sweep"), F.col("day").cast("string"))))
    matched = apply.commit_set_matches(sweeps, commits)
    return matched.select(
        "day",
        "packet_sha256",
        F.col("frozen_commits").cast("bigint").alias("frozen_commits"),
        F.col("current_commits").cast("bigint").alias("current_commits"),
        "unchanged",
    )
