"""State kept run by run: set digests, merged runs, changed days, and batches of whole days."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.bounds import PacketBounds
from ledgerloom.functions import ident, set_digest
from ledgerloom.operators import daily, documents, packets, range_trees
from ledgerloom.plans import oracle_ctes as o
from ledgerloom.plans.daily_queries import daily_records
from ledgerloom.plans.document_queries import DOCS_SQL, sample_documents
from ledgerloom.plans.packet_queries import PENDING_SQL, accounted_ids, applied_batches, available_records
from ledgerloom.plans.registry import query
from ledgerloom.plans.sample_tables import ZONE, sample_ledger, stored_once
from ledgerloom.session import work_folder
from ledgerloom.sources.run_tables import RunTables
from ledgerloom.streaming import replay_state

#: Small packets, so that days hold far more than one run's batches.
SMALL = PacketBounds(max_items=3, item_bytes=600, total_bytes=1_000)
RUNS = 10


def _digest_sql(member: str) -> str:
    """Set digest of a group's members: their number and 40 sums of six hex digits."""
    lanes = [
        f"sum(('0x' || substr(sha256('{k}:' || {member}), {6 * place + 1}, 6))::BIGINT) % 16777216"
        for k in range(4)
        for place in range(10)
    ]
    return f"sha256(count(*) || ':' || {reduce(lambda a, b: a + ' || chr(44) || ' + b, (f'({lane})' for lane in lanes))})"


@query(
    "next_fit_whole_days",
    o.with_(
        PENDING_SQL
        + f""",
bound AS (SELECT day, record_id, {o.truncated('text', 600)} AS bounded,
  row_number() OVER (PARTITION BY day ORDER BY captured_at, record_id) AS seq FROM daily),
sized AS (SELECT day, record_id, seq, strlen(bounded) AS bytes, sha256(bounded) AS packet_text_sha256 FROM bound),
walk AS (
  SELECT day, seq, record_id, bytes, packet_text_sha256, 1 AS batch_no, 1 AS item_no, bytes AS used FROM sized WHERE seq = 1
  UNION ALL
  SELECT s.day, s.seq, s.record_id, s.bytes, s.packet_text_sha256,
    CASE WHEN w.item_no >= 3 OR w.used + s.bytes > 1000 THEN w.batch_no + 1 ELSE w.batch_no END,
    CASE WHEN w.item_no >= 3 OR w.used + s.bytes > 1000 THEN 1 ELSE w.item_no + 1 END,
    CASE WHEN w.item_no >= 3 OR w.used + s.bytes > 1000 THEN s.bytes ELSE w.used + s.bytes END
  FROM walk w JOIN sized s ON s.day = w.day AND s.seq = w.seq + 1)
""",
        """SELECT day, record_id, CAST(batch_no AS BIGINT) AS batch_no, CAST(item_no AS BIGINT) AS item_no,
           CAST(bytes AS BIGINT) AS packet_bytes, packet_text_sha256 FROM walk""",
        recursive=True,
    ),
)
def next_fit_whole_days(spark: SparkSession, sf: str) -> DataFrame:
    """All small packets of every day, of which a day has far more than one run takes."""
    batched = packets.all_batched_items(available_records(spark, sf), SMALL, block_rows=128)
    return batched.select("day", "record_id", "batch_no", "item_no", "packet_bytes", "packet_text_sha256")


def _run_of(record_id: str) -> Column:
    """A run for every record, so that its days lie in many runs."""
    return F.pmod(F.conv(F.substring(record_id, 1, 6), 16, 10).cast("bigint"), F.lit(RUNS)).cast("int") + 1


def _digest_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Sums as runs would store them."""
    accounted = accounted_ids(available_records(spark, sf)).withColumn("run", _run_of("id"))
    return set_digest.summed(accounted, ["lane", "day", "run"], F.col("id"))


@query(
    "cursor_set_digest",
    o.with_(
        PENDING_SQL
        + f""",
sums AS (SELECT day, count(*) AS accounted, {_digest_sql('record_id')} AS accounted_sha256 FROM morning GROUP BY day)
""",
        """SELECT day, accounted, applied_batches, sha256('{"accounted_sha256":"' || s.accounted_sha256
             || '","applied_batches":["' || sha256(day || '#1') || '","' || sha256(day || '#2')
             || '"],"timezone":"Asia/Seoul"}') AS checkpoint_sha256
           FROM sums s JOIN (SELECT day, applied_batches FROM cursors) USING (day)""",
    ),
)
def cursor_set_digest(spark: SparkSession, sf: str) -> DataFrame:
    """Cursors from the sums of ten runs."""
    parts = stored_once("digest_parts", spark, sf, lambda: _digest_parts(spark, sf))
    records = available_records(spark, sf).select("day", "record_id", "captured_at")
    cursors = packets.cursors_of_digests(parts, applied_batches(records), ZONE)
    return cursors.drop("lane").withColumn("applied_batches", F.array_join("applied_batches", ","))


@query(
    "snapshot_set_digest",
    o.with_(
        DOCS_SQL
        + """,
now AS (SELECT target_key, CASE WHEN layer = 'mtm' THEN sha256('new ' || body) ELSE sha256 END AS sha256 FROM docs
  WHERE layer <> 'xltm' UNION ALL SELECT 'ltm/new//', sha256('Tree of new'))
""",
        f"SELECT count(*) AS documents, {_digest_sql(chr(40) + 'target_key || chr(32) || sha256' + chr(41))} AS snapshot_sha256 FROM now",
    ),
)
def snapshot_set_digest(spark: SparkSession, sf: str) -> DataFrame:
    """The snapshot after boards were replaced and a tree was added, from the sums before and of the change; the forest left."""
    docs = sample_documents(spark, sf)
    member = documents.document_member(F.col("target_key"), F.col("sha256"))
    before = set_digest.summed(docs, [], member)
    boards = docs.where("layer = 'mtm'").select("target_key", F.sha2(F.concat(F.lit("new "), "body"), 256).alias("sha256"))
    added = spark.range(1).select(F.lit("ltm/new//").alias("target_key"), ident.sha256_hex(F.lit("Tree of new")).alias("sha256"))
    moved = documents.snapshot_change(docs, boards.unionByName(added))
    gone = set_digest.summed(docs.where("layer = 'xltm'"), [], member, leaves=F.lit(True))
    return documents.snapshot_digest(before.unionByName(moved).unionByName(gone))


def _merged_store(spark: SparkSession, sf: str) -> RunTables:
    """Accounted ids committed in ten runs and merged in threes."""
    store = RunTables(spark, f"{work_folder(spark)}/runs")
    rows = accounted_ids(available_records(spark, sf)).withColumn("of", _run_of("id"))
    rows = rows.hint("rebalance").persist()
    for run in range(1, RUNS + 1):
        store.write("accounted", run, rows.where(F.col("of") == run).drop("of"))
        store.commit("daily", run, {})
    rows.unpersist()
    store.compact("daily", fanout=3)
    return store


@query(
    "merged_runs",
    o.with_(
        PENDING_SQL,
        f"""SELECT 'daily' AS lane, day, record_id AS id,
            CAST(('0x' || left(record_id, 6))::BIGINT % {RUNS} + 1 AS INTEGER) AS run FROM morning""",
    ),
)
def merged_runs(spark: SparkSession, sf: str) -> DataFrame:
    """A table of ten runs, nine of them merged, with every row's run."""
    return stored_once("merged_runs", spark, sf, lambda: _merged_store(spark, sf).read("accounted"))


@query(
    "changed_days",
    o.with_(
        o.DAILY,
        f"""SELECT day, count(*) AS late_records FROM daily
            WHERE ('0x' || left(record_id, 6))::BIGINT % {RUNS} + 1 > {RUNS - 1} GROUP BY day""",
    ),
)
def changed_days(spark: SparkSession, sf: str) -> DataFrame:
    """Days whose digests the newest run changes."""
    records = daily_records(spark, sf).select("day", "record_id").withColumn("run", _run_of("record_id"))
    return daily.changed_days(records, RUNS - 1)


def _tree_sql() -> str:
    """Levels of the tree over each log's lines, as ranges."""
    levels = ["n0 AS (SELECT source_ref, byte_start AS node, sha256(byte_start || ':' || byte_end || ':' || event_sha256) AS hash FROM ledger)"]
    for level in range(1, 5):
        cell = "node >> 16" if level < 4 else "node >> 62"
        levels.append(
            f"n{level} AS (SELECT source_ref, {cell} AS node, sha256(string_agg(node || ':' || hash, ',' ORDER BY node)) AS hash"
            f" FROM n{level - 1} GROUP BY source_ref, {cell})"
        )
    return ",\n".join(levels)


@query(
    "file_roots",
    o.with_(
        o.LEDGER + ",\n" + _tree_sql(),
        """SELECT source_ref AS source, ranges, reached, hash AS root_sha256 FROM n4 JOIN (SELECT source_ref, count(*) AS ranges,
           CAST(max(byte_end) AS BIGINT) AS reached FROM ledger GROUP BY source_ref) USING (source_ref)""",
    ),
)
def file_roots(spark: SparkSession, sf: str) -> DataFrame:
    """Roots of the logs' trees, with each message's line as a range."""
    place = F.col("provenance")
    segments = sample_ledger(spark, sf).select(
        place["source_ref"].alias("source"), place["byte_start"].alias("range_start"),
        place["byte_end"].alias("range_end"), place["event_sha256"].alias("sha256"),
    )
    return range_trees.roots(segments)


def _replayed(spark: SparkSession, sf: str) -> DataFrame:
    """Statuses of two streams on one checkpoint: all records, then all again, some with other content."""
    place = work_folder(spark)
    schema = "record_id string, content_sha256 string"
    records = sample_ledger(spark, sf).select("record_id", "role", F.col("text_sha256").alias("content_sha256"))
    changed = (F.col("role") == "assistant") & (F.substring("record_id", 1, 1) < "8")
    other = F.when(changed, ident.sha256_hex(F.concat(F.lit("changed "), "content_sha256"))).otherwise(F.col("content_sha256"))
    for rows in (records, records.withColumn("content_sha256", other)):
        rows.select("record_id", "content_sha256").write.mode("append").parquet(f"{place}/in")
        found = replay_state.replay_status(spark.readStream.schema(schema).parquet(f"{place}/in"))
        writer = found.writeStream.format("parquet").option("checkpointLocation", f"{place}/checkpoint")
        query = writer.outputMode("append").trigger(availableNow=True).start(f"{place}/out")
        query.awaitTermination()
        if query.exception():
            raise query.exception()
    return spark.read.schema(replay_state.SCHEMA).parquet(f"{place}/out")


@query(
    "stream_replay_status",
    o.with_(
        o.LEDGER,
        """SELECT record_id, text_sha256 AS content_sha256, 'new' AS status FROM ledger UNION ALL
           SELECT record_id, CASE WHEN role = 'assistant' AND left(record_id, 1) < '8'
             THEN sha256('changed ' || text_sha256) ELSE text_sha256 END,
             CASE WHEN role = 'assistant' AND left(record_id, 1) < '8' THEN 'conflict' ELSE 'duplicate' END FROM ledger""",
    ),
)
def stream_replay_status(spark: SparkSession, sf: str) -> DataFrame:
    """What keyed state says of records that come twice, across a restart."""
    return stored_once("replayed", spark, sf, lambda: _replayed(spark, sf))
