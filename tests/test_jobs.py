from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.bounds import DigestBounds, PacketBounds
from ledgerloom.functions import ident, routes
from ledgerloom.operators import apply, documents, packets
from ledgerloom.plans import jobs
from ledgerloom.sources.run_tables import RunTables, RunTakenError


def event(text, minute=0, role="user", kind="message", day="2024-07-24") -> bytes:
    body = {
        "timestamp": f"{day}T09:{minute:02d}:00Z",
        "type": "response_item",
        "payload": {"type": kind, "role": role, "content": [{"type": "input_text", "text": text}]},
    }
    return json.dumps(body).encode() + b"\n"


LOG = event("first") + event("second", 1, "assistant") + event("tool", 2, kind="function_call")


@pytest.fixture
def logs(tmp_path):
    folder = tmp_path / "logs" / "2024"
    folder.mkdir(parents=True)
    (folder / "one.jsonl").write_bytes(LOG)
    return tmp_path / "logs"


@pytest.fixture
def store(spark, tmp_path):
    return RunTables(spark, str(tmp_path / "store"))


def ledger_rows(store):
    return sorted(tuple(map(str, row)) for row in store.read("ledger").drop("run").collect())


def test_ingest_twice_and_hide_paths(spark, logs, store):
    assert vars(jobs.ingest(spark, str(logs), store)) == {
        "new_records": 2, "duplicate_records": 0, "sources_checked": 1, "pending_bytes": 0, "unsupported_events": 1,
        "rejected_events": 0, "unsupported_total": 1,
    }
    before = ledger_rows(store)
    again = jobs.ingest(spark, str(logs), store)
    assert (again.new_records, again.duplicate_records, again.unsupported_events) == (0, 0, 0)
    assert ledger_rows(store) == before
    assert "one.jsonl" not in str(before)


def test_unfinished_line_waits(spark, logs, store):
    jobs.ingest(spark, str(logs), store)
    path = logs / "2024" / "one.jsonl"
    line = event("third", 3)
    path.write_bytes(LOG + line[:-1])
    result = jobs.ingest(spark, str(logs), store)
    assert (result.new_records, result.pending_bytes) == (0, len(line) - 1)
    path.write_bytes(LOG + line)
    result = jobs.ingest(spark, str(logs), store)
    assert (result.new_records, result.pending_bytes) == (1, 0)
    assert store.read("ledger").count() == 3


def test_edited_prefix_fails_and_changes_nothing(spark, logs, store):
    jobs.ingest(spark, str(logs), store)
    before = ledger_rows(store)
    (logs / "2024" / "one.jsonl").write_bytes(LOG.replace(b"first", b"fiRst"))
    with pytest.raises(jobs.SourceMutationError):
        jobs.ingest(spark, str(logs), store)
    (logs / "2024" / "one.jsonl").write_bytes(LOG[:20])
    with pytest.raises(jobs.SourceMutationError):
        jobs.ingest(spark, str(logs), store)
    assert store.last_run("ingest") == 1 and ledger_rows(store) == before


def test_missing_source_fails(spark, logs, store):
    jobs.ingest(spark, str(logs), store)
    (logs / "2024" / "one.jsonl").rename(logs / "2024" / "two.jsonl")
    with pytest.raises(jobs.LedgerError, match="unavailable"):
        jobs.ingest(spark, str(logs), store)


def test_malformed_line_fails_unless_kept_apart(spark, logs, store):
    (logs / "2024" / "bad.jsonl").write_bytes(b"{nope}\n" + event("good", 5))
    with pytest.raises(Exception, match="malformed"):
        jobs.ingest(spark, str(logs), store)
    assert store.last_run("ingest") == 0 and store.read("ledger").count() == 0
    result = jobs.ingest(spark, str(logs), store, on_reject="quarantine")
    assert (result.new_records, result.unsupported_events, result.rejected_events) == (3, 1, 1)
    kept = store.read("rejected").first()
    assert bytes(kept["raw"]).strip() == b"{nope}" and kept["source"] == "2024/bad.jsonl"
    (logs / "2024" / "more.jsonl").write_bytes(event("tool", 2, kind="function_call"))
    assert jobs.ingest(spark, str(logs), store).unsupported_total == 2


def test_one_of_two_writers_is_refused(spark, logs, store):
    other = RunTables(spark, store.root)
    commit = RunTables.commit

    def overtaken(self, lane, run, counters):
        RunTables.commit = commit
        jobs.ingest(spark, str(logs), other)
        commit(self, lane, run, counters)

    try:
        RunTables.commit = overtaken
        with pytest.raises(RunTakenError):
            jobs.ingest(spark, str(logs), store)
    finally:
        RunTables.commit = commit
    assert store.read("ledger").count() == 2 and store.last_run("ingest") == 1
    assert jobs.ingest(spark, str(logs), store).new_records == 0


def test_same_content_elsewhere_is_kept(spark, logs, store):
    jobs.ingest(spark, str(logs), store)
    (logs / "copy.jsonl").write_bytes(LOG)
    assert jobs.ingest(spark, str(logs), store).new_records == 2
    assert store.read("ledger").select("record_id").distinct().count() == 4


def test_crash_before_commit_is_replayed(spark, logs, store):
    jobs.ingest(spark, str(logs), store)
    (logs / "2024" / "two.jsonl").write_bytes(event("late", 7))
    commit = RunTables.commit
    try:
        RunTables.commit = lambda *_: (_ for _ in ()).throw(RuntimeError("lost"))
        with pytest.raises(RuntimeError):
            jobs.ingest(spark, str(logs), store)
    finally:
        RunTables.commit = commit
    assert store.read("ledger").count() == 2
    assert jobs.ingest(spark, str(logs), store).new_records == 1
    assert store.read("ledger").count() == 3


def test_leftover_rows_must_be_replays(spark, logs, store):
    jobs.ingest(spark, str(logs), store)
    alien = store.read_run("ledger", 1).withColumn("text_sha256", F.lit("0" * 64))
    store.write("ledger", 2, alien, ("utc_day",))
    with pytest.raises(jobs.LedgerError, match="exact replays"):
        jobs.ingest(spark, str(logs), store)


def test_replay_counts_duplicates_and_finds_conflicts(spark, logs, store):
    jobs.ingest(spark, str(logs), store)
    (logs / "2024" / "two.jsonl").write_bytes(event("x" * 100, 7))
    result = jobs.ingest(spark, str(logs), store, replay=True)
    assert (result.new_records, result.duplicate_records) == (1, 2)
    with pytest.raises(Exception, match="conflicting record"):
        jobs.ingest(spark, str(logs), store, replay=True, max_chars=64)


def test_digests_and_archive(spark, logs, store, tmp_path):
    (logs / "next.jsonl").write_bytes(event("third", 1, day="2024-07-25"))
    jobs.ingest(spark, str(logs), store)
    folder, archive = str(tmp_path / "digests"), str(tmp_path / "archive")
    days = spark.createDataFrame([("2024-07-24",), ("2024-07-30",)], "d string").select(F.col("d").cast("date").alias("day"))

    def documents_in(path):
        rows = spark.read.text(path, wholetext=True)
        return {str(r["day"]): r["value"] for r in rows.collect()}

    jobs.write_daily_digests(store, folder)
    whole = documents_in(folder)
    assert set(whole) == {"2024-07-24", "2024-07-25"}
    assert whole["2024-07-24"].count("\n> ") == 2 and whole["2024-07-24"].endswith("\n")
    jobs.write_daily_digests(store, folder, bounds=DigestBounds(max_records=1), days=days)
    part = documents_in(folder)
    assert part["2024-07-25"] == whole["2024-07-25"]
    assert part["2024-07-24"].count("\n> ") == 1 and "Shown 1, left out 1," in part["2024-07-24"]
    assert "Shown 0, left out 0," in part["2024-07-30"]
    dry = jobs.archive_digests(spark, folder, archive, "2024-07-31", 5)
    assert sorted(str(r["day"]) for r in dry.collect()) == ["2024-07-24", "2024-07-25"]
    assert not store.exists(archive)
    for _ in range(2):
        jobs.archive_digests(spark, folder, archive, "2024-07-31", 5, apply_copy=True)
        assert documents_in(archive) == {d: t for d, t in part.items() if d < "2024-07-26"}
    jobs.write_daily_digests(store, folder)
    with pytest.raises(jobs.LedgerError, match="differs"):
        jobs.archive_digests(spark, folder, archive, "2024-07-31", 5, apply_copy=True)


def decide(items, omit="nothing"):
    """One entry per item, except items with the given text."""
    kept = items.where(F.col("packet_text") != omit)
    entries = kept.select(
        "packet_sha256", F.col("seq").alias("entry_no"), F.array("record_id").alias("source_record_ids"),
        F.concat(F.lit("Summary of "), "packet_text").alias("summary"),
    )
    omitted = items.where(F.col("packet_text") == omit).select("packet_sha256", "record_id", F.lit("redundant").alias("reason"))
    return entries, omitted


def made_by(prepared):
    """A well named producer for every packet."""
    return prepared.selectExpr(
        "packet_sha256", "'tool' AS kind", "'1' AS tool_version", "'m' AS model", "'high' AS reasoning_effort", "'p' AS isolation_profile"
    )


def frozen(spark, df, path):
    df.write.mode("overwrite").parquet(str(path))
    return spark.read.parquet(str(path))


def test_daily_packets_drain_and_apply_once(spark, logs, store, tmp_path):
    bounds = PacketBounds(max_items=4, item_bytes=32, total_bytes=160)
    lines = b"".join(event(f"message {i}", i) for i in range(5))
    (logs / "2024" / "more.jsonl").write_bytes(lines)
    jobs.ingest(spark, str(logs), store)
    left, seen = [], set()
    for number in range(2):
        prepared = frozen(spark, jobs.prepare_daily_packets(store, bounds=bounds), tmp_path / f"p{number}")
        items = packets.exploded_items(prepared)
        decisions = decide(items, "second")
        if number == 0:
            again = jobs.prepare_daily_packets(store, bounds=bounds).first()
            assert again["packet_sha256"] == prepared.first()["packet_sha256"]
            with pytest.raises(jobs.LedgerError, match="invalid"):
                jobs.apply_daily(store, prepared, decisions[0].where("entry_no > 1"), decisions[1], producers=made_by(prepared))
        named = made_by(prepared)
        with pytest.raises(jobs.LedgerError, match="invalid"):
            jobs.apply_daily(store, prepared, *decisions, producers=named.where("false"))
        with pytest.raises(TypeError, match="producers"):
            jobs.apply_daily(store, prepared, *decisions)
        with pytest.raises(jobs.LedgerError, match="invalid"):
            jobs.apply_daily(store, prepared, *decisions, producers=named.withColumn("reasoning_effort", F.lit("much")))
        of_day = jobs.prepare_daily_packets(store, bounds=bounds, day=str(prepared.first()["day"])).first()
        assert of_day["packet_sha256"] == prepared.first()["packet_sha256"]
        assert jobs.apply_daily(store, prepared, *decisions, producers=named) == 1
        left.append(prepared.first()["not_yet_admitted"])
        seen |= {r["record_id"] for r in items.collect()}
        if number == 0:
            first = prepared, decisions
    assert left == [3, 0] and len(seen) == 7
    assert jobs.prepare_daily_packets(store, bounds=bounds).count() == 0
    assert store.read("entries").count() == 6 and store.last_run("daily") == 2
    assert jobs.apply_daily(store, first[0], *first[1], producers=made_by(first[0])) == 0
    other = first[1][0].withColumn("summary", F.lit("Different"))
    with pytest.raises(jobs.LedgerError, match="stale"):
        jobs.apply_daily(store, first[0], other, first[1][1], producers=made_by(first[0]))
    late = event("late", 30)
    (logs / "2024" / "more.jsonl").write_bytes(lines + late)
    jobs.ingest(spark, str(logs), store)
    assert [i["packet_text"] for i in jobs.prepare_daily_packets(store, bounds=bounds).first()["items"]] == ["late"]


def test_all_omitted_batch_closes(spark, logs, store, tmp_path):
    jobs.ingest(spark, str(logs), store)
    prepared = frozen(spark, jobs.prepare_daily_packets(store), tmp_path / "p")
    items = packets.exploded_items(prepared)
    omitted = items.select("packet_sha256", "record_id", F.lit("low_signal").alias("reason"))
    entries, _ = decide(items.where("false"))
    assert jobs.apply_daily(store, prepared, entries, omitted, producers=made_by(prepared)) == 1
    assert jobs.prepare_daily_packets(store).count() == 0
    assert "| included | 0 |\n| omitted | 2 |" in store.read("batch_documents").first()["document"]


def test_documents_are_created_and_replaced(spark, logs, store, tmp_path):
    jobs.ingest(spark, str(logs), store)
    prepared = frozen(spark, jobs.prepare_daily_packets(store), tmp_path / "p")
    jobs.apply_daily(store, prepared, *decide(packets.exploded_items(prepared)), producers=made_by(prepared))
    packet = jobs.prepare_sweep_packets(store).first()
    assert packet["stage"] == packets.DOCUMENT_STAGE and len(packet["items"]) == 2
    assert jobs.prepare_sweep_packets(store).first()["packet_sha256"] == packet["packet_sha256"]
    swept = frozen(spark, jobs.prepare_sweep_packets(store), tmp_path / "s")
    sha = packet["packet_sha256"]
    none = F.lit(None).cast("string")

    def target(layer, *parts):
        named = [F.lit(p).alias(n) for p, n in zip(parts, routes.PARTS, strict=False)]
        return F.struct(F.lit(layer).alias("layer"), *named, *[none.alias(n) for n in routes.PARTS[len(parts):]])

    def change(number, where, action="create", expected=None, body="Body", packet_sha256=sha):
        return spark.range(1).select(
            F.lit(packet_sha256).alias("packet_sha256"), F.lit(number).alias("change_no"), F.lit(action).alias("action"),
            where.alias("target"), F.lit(expected).cast("string").alias("expected_sha256"), F.lit(body).alias("body"),
            F.array().cast("array<string>").alias("source_entry_ids"),
            F.lit("why").alias("reason"), F.lit("high").alias("confidence"),
        )

    def promoted(stored, where):
        return packets.exploded_items(stored).select(
            "packet_sha256", "entry_id", F.lit("promoted").alias("status"), F.array(where).alias("targets"), F.lit("kept").alias("reason"),
        )

    def snapshot():
        return documents.snapshot_hash(jobs.current_documents(store)).first()["snapshot_sha256"]

    def context(packet_sha256):
        return jobs.current_documents(store).select(F.lit(packet_sha256).alias("packet_sha256"), "target_key", F.col("sha256").alias("document_sha256"))

    chain = [target("xltm"), target("ltm", "work"), target("mtm", "work", "spark"), target("stm", "work", "spark", "note")]
    creates = change(0, chain[0])
    for number, where in enumerate(chain[1:], start=1):
        creates = creates.unionByName(change(number, where))
    decided = promoted(swept, chain[3])
    empty = snapshot()
    with pytest.raises(jobs.LedgerError, match="parent"):
        jobs.apply_documents(store, swept, context(sha), creates.where("change_no <> 2"), decided, empty, producers=made_by(swept))
    with pytest.raises(jobs.LedgerError, match="invalid"):
        jobs.apply_documents(store, swept, context(sha), creates, decided.where("false"), empty, producers=made_by(swept))
    with pytest.raises(jobs.LedgerError, match="snapshot"):
        jobs.apply_documents(store, swept, context(sha), creates, decided, "0" * 64, producers=made_by(swept))
    with pytest.raises(jobs.LedgerError, match="commits changed"):
        jobs.apply_documents(store, swept.withColumn("source_version", F.lit("0" * 64)), context(sha), creates, decided, empty, producers=made_by(swept))
    with pytest.raises(jobs.LedgerError, match="stale"):
        jobs.apply_documents(store, swept.withColumn("cursor_sha256", F.lit("0" * 64)), context(sha), creates, decided, empty, producers=made_by(swept))
    assert jobs.apply_documents(store, swept, context(sha), creates, decided, empty, producers=made_by(swept)) == 1
    assert jobs.current_documents(store).count() == 4
    assert jobs.prepare_sweep_packets(store).count() == 0
    # The same decisions again change nothing; others for the packet are refused.
    assert jobs.apply_documents(store, swept, context(sha), creates, decided, empty, producers=made_by(swept)) == 1
    with pytest.raises(jobs.LedgerError, match="other decisions"):
        jobs.apply_documents(store, swept, context(sha), change(0, chain[0], body="Other"), decided, empty, producers=made_by(swept))
    (logs / "2024" / "later.jsonl").write_bytes(event("later", 30))
    jobs.ingest(spark, str(logs), store)
    later = frozen(spark, jobs.prepare_daily_packets(store), tmp_path / "p2")
    jobs.apply_daily(store, later, *decide(packets.exploded_items(later)), producers=made_by(later))
    second = frozen(spark, jobs.prepare_sweep_packets(store), tmp_path / "s2")
    sha2 = second.first()["packet_sha256"]
    old = spark.range(1).select(ident.sha256_hex(F.lit("Body"))).first()[0]
    blind = spark.createDataFrame([], "packet_sha256 string, target_key string, document_sha256 string")
    with pytest.raises(jobs.LedgerError, match="preimage"):
        jobs.apply_documents(store, second, blind, change(0, chain[3], packet_sha256=sha2), promoted(second, chain[3]), snapshot(), producers=made_by(second))
    with pytest.raises(jobs.LedgerError, match="context row"):
        alien = context(sha2).withColumn("document_sha256", F.when(F.col("target_key").startswith("ltm"), F.lit("0" * 64)).otherwise(F.col("document_sha256")))
        good = change(0, chain[3], "replace", old, "New body", packet_sha256=sha2)
        jobs.apply_documents(store, second, alien, good, promoted(second, chain[3]), snapshot(), producers=made_by(second))
    wrong = change(0, chain[3], "replace", "0" * 64, packet_sha256=sha2)
    with pytest.raises(jobs.LedgerError, match="preimage"):
        jobs.apply_documents(store, second, context(sha2), wrong, promoted(second, chain[3]), snapshot(), producers=made_by(second))
    replaced = change(0, chain[3], "replace", old, "New body", packet_sha256=sha2)
    assert jobs.apply_documents(store, second, context(sha2), replaced, promoted(second, chain[3]), snapshot(), producers=made_by(second)) == 2
    bodies = {r["target_key"]: r["body"] for r in jobs.current_documents(store).collect()}
    assert bodies["stm/work/spark/note"] == "New body" and len(bodies) == 4
    assert store.read("sweeps").count() == 2


def test_damaged_batches_stop_a_sweep(spark, logs, store, tmp_path):
    jobs.ingest(spark, str(logs), store)
    prepared = frozen(spark, jobs.prepare_daily_packets(store), tmp_path / "p")
    jobs.apply_daily(store, prepared, *decide(packets.exploded_items(prepared)), producers=made_by(prepared))
    changed = store.read_run("batch_documents", 1).withColumn("document", F.lit("changed"))
    changed = spark.createDataFrame(changed.collect(), changed.schema)
    store.write("batch_documents", 1, changed)
    with pytest.raises(jobs.LedgerError, match="commit does not hold"):
        jobs.prepare_sweep_packets(store)


def test_a_day_may_have_any_number_of_commits(spark):
    rows = [(f"{i:064x}", f"{(i * 7919) % 600:064x}") for i in range(600)]
    commits = spark.createDataFrame(rows, "batch_id string, commit_sha256 string").withColumn("day", F.lit("2024-01-01").cast("date"))
    first = apply.commit_digests(commits).first()["source_version"]
    assert apply.commit_digests(commits.repartition(5)).first()["source_version"] == first
    assert apply.commit_digests(commits.where("batch_id <> '%s'" % rows[5][0])).first()["source_version"] != first
