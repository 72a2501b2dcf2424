from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from ledgerloom.bounds import MAX_CHANGES, MAX_DAILY_ENTRIES, PacketBounds
from ledgerloom.operators import apply, decisions, documents, packets

P = "f" * 64


def sha(value: str) -> str:
    return hashlib.sha256(value.encode()).hexdigest()


def rules(df) -> set[tuple[str, str]]:
    return {(row["rule"], row["subject"]) for row in df.collect()}


ENTRIES = "packet_sha256 string, entry_no int, source_record_ids array<string>, summary string"
OMITTED = "packet_sha256 string, record_id string, reason string"
TARGET = "struct<layer:string,tree:string,branch:string,leaf:string>"
CHANGES = (
    f"packet_sha256 string, change_no int, action string, target {TARGET}, expected_sha256 string, body string, "
    "source_entry_ids array<string>, reason string, confidence string"
)
DISPOSITIONS = f"packet_sha256 string, entry_id string, status string, targets array<{TARGET}>, reason string"
CONTEXT = "packet_sha256 string, target_key string, document_sha256 string"


def items_of(spark, *ids):
    return spark.createDataFrame([(P, i) for i in ids], "packet_sha256 string, item_id string")


def test_daily_rules(spark):
    a, b, c, d = (sha(x) for x in "abcd")
    items = items_of(spark, a, b, c, d)
    good = spark.createDataFrame([(P, 1, [a, b], "fine")], ENTRIES), spark.createDataFrame(
        [(P, c, "redundant"), (P, d, "sensitive")], OMITTED
    )
    assert rules(decisions.validate_daily(items, *good)) == set()
    bad = spark.createDataFrame(
        [(P, 1, [a, a], "twice"), (P, 2, [], "none"), (P, 3, ["zz"], "\x07"), (P, 4, [b], "x" * 1201)], ENTRIES
    ), spark.createDataFrame([(P, b, "redundant"), (P, "nope", "bored")], OMITTED)
    assert rules(decisions.validate_daily(items, *bad)) == {
        ("entry_source_repeated", "1"), ("entry_source_count", "2"), ("entry_source_id", "3"), ("entry_summary", "3"),
        ("entry_summary", "4"), ("omission_id", "nope"), ("omission_reason", "nope"), ("coverage_repeated", a),
        ("coverage_repeated", b), ("coverage_unknown", "zz"), ("coverage_unknown", "nope"), ("coverage_missing", c),
        ("coverage_missing", d),
    }
    many = spark.createDataFrame([(P, n, [a], "s") for n in range(MAX_DAILY_ENTRIES + 1)], ENTRIES)
    assert ("entry_count", str(MAX_DAILY_ENTRIES + 1)) in rules(decisions.validate_daily(items, many, good[1]))


def test_producers(spark):
    rows = [
        (P, "tool", "1.2", "vendor/model-1", "high", "sealed"),
        (P, "", "1.2", "-bad", "huge", "sealed\n"),
    ]
    results = spark.createDataFrame(
        rows, "packet_sha256 string, kind string, tool_version string, model string, reasoning_effort string, isolation_profile string"
    )
    assert {rule for rule, _ in rules(decisions.producer_violations(results))} == {
        "producer_kind", "producer_model", "producer_effort", "producer_profile",
    }
    a = sha("a")
    good = spark.createDataFrame([(P, 1, [a], "fine")], ENTRIES), spark.createDataFrame([], OMITTED)
    one = results.where("kind = 'tool'")
    items = items_of(spark, a)
    assert rules(decisions.validate_daily(items, *good, producers=one)) == set()
    assert rules(decisions.validate_daily(items, *good, producers=one.where("false"))) == {("producer_missing", "0")}
    assert rules(decisions.validate_daily(items, *good, producers=one.union(one))) == {("producer_repeated", "2")}
    stray = one.union(one.selectExpr("'0' AS packet_sha256", *one.columns[1:]))
    assert rules(decisions.validate_daily(items, *good, producers=stray)) == {("producer_unknown", "1")}


STM = ("stm", "t", "b", "leaf")
BOARD = ("mtm", "t", "b", None)


def change(number=1, action="create", target=STM, expected=None, body="Body", sources=(), reason="r", confidence="low"):
    return (P, number, action, target, expected, body, list(sources), reason, confidence)


def structured(spark, items, changes, dispositions, context=()):
    return rules(
        decisions.validate_structured(
            items_of(spark, *items),
            spark.createDataFrame(list(context), CONTEXT),
            spark.createDataFrame(changes, CHANGES),
            spark.createDataFrame(dispositions, DISPOSITIONS),
        )
    )


def test_structured_accepts_each_status(spark):
    key, board = "stm/t/b/leaf", "mtm/t/b/"
    dispositions = [
        (P, "e1", "promoted", [STM, BOARD], "r"), (P, "e2", "already_covered", [BOARD], "r"),
        (P, "e3", "source_only", [], "r"), (P, "e4", "promotion_debt", [STM], "r"),
    ]
    replaced = change(action="replace", expected=sha("old"), sources=["e1", "e4"])
    context = [(P, key, sha("old")), (P, board, sha("board"))]
    assert structured(spark, ["e1", "e2", "e3", "e4"], [replaced], dispositions, context) == set()


def test_structured_faults(spark):
    key = "stm/t/b/leaf"
    found = structured(
        spark,
        ["e1", "e2", "e3", "e4", "e5"],
        [
            change(1, sources=["e1", "ghost"], confidence="sure", reason="two\nlines", body=" "),
            change(2, action="merge", target=("ltm", "t", "b", None), sources=["e2", "e2"]),
            change(3, action="replace", expected="0" * 64, target=("mtm", "t", "x", None)),
        ],
        [
            (P, "e1", "promoted", [BOARD], "r"), (P, "e2", "source_only", [STM], "r"), (P, "e3", "maybe", [STM, STM], "r"),
            (P, "e4", "already_covered", [BOARD], ""), (P, "e4", "promotion_debt", [], "r"),
        ],
        [(P, key, sha("old"))],
    )
    assert found == {
        ("change_confidence", "1"), ("change_reason", "1"), ("change_body", "1"), ("change_create_conflict", key),
        ("change_action", "2"), ("change_target", "2"), ("change_source_repeated", "2"), ("change_preimage_mismatch", "mtm/t/x/"),
        ("change_source_unknown", "ghost"), ("change_source_unmatched", f"{key} e1"), ("change_source_unmatched", f"{key} ghost"),
        ("change_source_unmatched", "ltm/t/b/ e2"), ("disposition_status", "e3"), ("disposition_target_repeated", "e3"),
        ("disposition_reason", "e4"), ("disposition_not_changed", "e1"), ("disposition_unexpected_targets", "e2"),
        ("disposition_not_in_context", "e4"), ("disposition_missing_targets", "e4"), ("coverage_repeated", "e4"),
        ("coverage_missing", "e5"),
    }


def test_one_target_is_changed_once_and_changes_are_bounded(spark):
    leaves = [("stm", "t", "b", f"leaf{n}") for n in range(MAX_CHANGES)]
    changes = [change(n, target=leaf) for n, leaf in enumerate(leaves)] + [change(99, target=leaves[0])]
    found = structured(spark, ["e1"], changes, [(P, "e1", "source_only", [], "r")])
    assert found == {("change_target_repeated", "stm/t/b/leaf0"), ("change_count", str(MAX_CHANGES + 1))}


def test_context_problems(spark):
    entries = spark.createDataFrame([(P, "e1"), (P, "e2")], "packet_sha256 string, entry_id string")
    bindings = spark.createDataFrame([(P, "e1", "a"), (P, "e1", "b"), (P, "e1", "c")], "packet_sha256 string, entry_id string, path string")
    docs = spark.createDataFrame(
        [(P, "a", "1"), (P, "a", "1"), (P, "b", "1"), (P, "b", "2")], "packet_sha256 string, path string, document_sha256 string"
    )
    found = documents.context_join(entries, bindings, docs).collect()
    assert {(r["entry_id"], r["path"]): r["outcome"] for r in found} == {
        ("e1", "a"): "ok", ("e1", "b"): "conflict", ("e1", "c"): "unknown_path", ("e2", None): "no_document",
    }


def test_document_rules(spark):
    def row(path="a/b.md", layer="stm", body="text", title="Title", size=None, digest=None, mtime=1):
        route = (layer, "t", "b", "l", path)
        return (route, title, body, digest or sha(body), len(body.encode()) if size is None else size, mtime)

    schema = (
        "route struct<layer:string,tree:string,branch:string,leaf:string,path:string>, title string, body string, "
        "sha256 string, size long, mtime_ns long"
    )
    rows = [row(), row(path="../x"), row(layer="top"), row(title="two\nlines"), row(size=3), row(digest="0" * 64), row(mtime=-1)]
    found = documents.document_violations(spark.createDataFrame(rows, schema)).select("rule").collect()
    assert sorted(r["rule"] for r in found) == ["layer", "mtime_ns", "path", "sha256", "size", "title"]


def test_parents_of_the_same_batch_count(spark):
    docs = spark.createDataFrame([("xltm///",), ("stm/t/b/l",)], "target_key string")
    assert {r["parent_key"] for r in documents.orphans(docs).collect()} == {"mtm/t/b/"}
    created = spark.createDataFrame([("mtm/t/b/",), ("ltm/t//",)], "target_key string")
    assert documents.orphans(docs, created).count() == 0
    assert documents.orphans(docs, created.where("target_key like 'mtm%'")).first()["parent_key"] == "ltm/t//"


def test_snapshot_hash_follows_content(spark):
    docs = spark.range(500).select(F.concat(F.lit("stm/a/b/"), "id").alias("target_key"), F.sha2(F.col("id").cast("string"), 256).alias("sha256"))
    first = documents.snapshot_hash(docs).first()
    again = documents.snapshot_hash(docs.repartition(7)).first()
    other = documents.snapshot_hash(docs.withColumn("sha256", F.when(F.col("target_key") == "stm/a/b/7", F.lit("0")).otherwise(F.col("sha256")))).first()
    assert first == again and first["documents"] == 500 and first["snapshot_sha256"] != other["snapshot_sha256"]
    empty = documents.snapshot_hash(docs.where("false")).first()
    assert (empty["documents"], empty["snapshot_sha256"]) == (0, sha(""))


def test_cursor_checkpoint_follows_ids_and_order(spark):
    ids = spark.range(300).select(F.lit("daily").alias("lane"), F.lit("2024-01-01").cast("date").alias("day"), F.sha2(F.col("id").cast("string"), 256).alias("id"))
    batches = spark.createDataFrame([("daily", 1, "x"), ("daily", 2, "y")], "lane string, batch_seq int, batch_id string").withColumn(
        "day", F.lit("2024-01-01").cast("date")
    )

    def value(ids, batches):
        return packets.cursor_checkpoints(ids, batches).first()["checkpoint_sha256"]

    base = value(ids, batches)
    assert value(ids.repartition(5), batches) == base
    assert value(ids.limit(299), batches) != base
    assert value(ids, batches.withColumn("batch_seq", -F.col("batch_seq"))) != base
    nothing = spark.range(1).select(packets.empty_checkpoint_sha256(F.lit("UTC")).alias("c")).first()["c"]
    assert nothing != base


def test_packet_bounds():
    for wrong in ({"max_items": 0}, {"max_items": 201}, {"item_bytes": 31}, {"total_bytes": 160_001}):
        try:
            PacketBounds(**wrong)
        except ValueError:
            continue
        raise AssertionError(wrong)


def test_write_once_and_union(spark):
    stored = spark.createDataFrame([("a", "1"), ("b", "2")], "k string, v string")
    incoming = spark.createDataFrame([("a", "1"), ("b", "3"), ("c", "4")], "k string, v string")
    found = apply.write_once(incoming, stored, "k", "v").collect()
    assert {r["k"]: r["status"] for r in found} == {"a": "identical", "b": "conflict", "c": "new"}
