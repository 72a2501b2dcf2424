from __future__ import annotations

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import events
from ledgerloom.operators import ledger


def strict(raw: bytes) -> bool:
    """Independent check: one strict JSON object, no duplicate keys or lone surrogates."""

    def pairs(items):
        keys = [key for key, _ in items]
        if len(set(keys)) != len(keys):
            raise ValueError("duplicate")
        return dict(items)

    def integer(digits):
        if len(digits.lstrip("-")) > 64:
            raise ValueError("too long")
        return int(digits)

    def constant(_):
        raise ValueError("constant")

    def decimal(number):
        if not Decimal(number).is_finite():
            raise ValueError("not finite")
        return 0

    try:
        value = json.loads(
            raw.decode("utf-8"), object_pairs_hook=pairs, parse_int=integer, parse_constant=constant, parse_float=decimal
        )
    except (ValueError, ArithmeticError):
        return False
    try:
        json.dumps(value, ensure_ascii=False).encode("utf-8")
    except UnicodeEncodeError:
        return False
    return isinstance(value, dict)


CASES = [
    b'{"a":1}\n', b' {"a":1} \r\n', b'{}\n', b'[]\n', b'"x"\n', b'1\n', b'null\n', b'{"a":1} x\n', b'{"a":1}{"b":2}\n',
    b'{"a":1},"b":{"c":2}\n', b'{"a":1},"r":{}\n', b'{"a":1}]\n', b'{"a":1,"a":2}\n', b'{"o":{"k":1,"k":2}}\n',
    b'{"a":NaN}\n', b'{"a":Infinity}\n', b'{"a":-Infinity}\n', b'{"a":01}\n', b'{"a":.5}\n', b'{"a":1.}\n', b'{"a":+1}\n',
    b'{"a":1e400}\n', b'{"a":' + b"9" * 64 + b'}\n', b'{"a":' + b"9" * 65 + b'}\n', b'{"a":-' + b"9" * 64 + b'}\n',
    b'{"a":-' + b"9" * 65 + b'}\n', b'{"a":0.' + b"1" * 70 + b'}\n', b'{"a":"' + b"9" * 80 + b'"}\n',
    b'{"a":"\\"' + b"9" * 80 + b'"}\n', b'{"a":1e' + b"9" * 25 + b'}\n', b'{"a":"\\ud83d\\ude00"}\n', b'{"a":"\\ud83d"}\n',
    b'{"a":"\\ude00"}\n', b'{"a":"\\\\ud83d"}\n', b'{"a":"\\\\\\ud83d"}\n', b'{"\\ud800":1}\n', b'{"a":"\xff"}\n',
    b'{"a":"\xed\xa0\x80"}\n', b'{"a":"\x01"}\n', b'{"a":"\\u0000"}\n', "{\"a\":\"\u2028\"}\n".encode(), b'{"a":tru}\n',
    b"{'a':1}\n", b'{"a":1,}\n', b'{"a":1 /* c */}\n', b'\xef\xbb\xbf{"a":1}\n', b'{"a":{"b":[1,{"c":null}]}}\n', b'{"a"\n',
]


def test_strict_json_agrees_with_an_independent_parser(spark):
    rows = spark.createDataFrame([(i, bytearray(raw)) for i, raw in enumerate(CASES)], "i int, raw binary")
    found = events.with_strict_event(rows).select("i", "reject_reason", F.col("event").isNotNull().alias("kept")).collect()
    for row in found:
        assert row["kept"] == strict(CASES[row["i"]]), (CASES[row["i"]], row["reject_reason"])
        assert row["kept"] == (row["reject_reason"] is None)


def test_oversize_counts_the_newline(spark):
    raw = b'{"a":1}\n'
    rows = spark.createDataFrame([(bytearray(raw),)], "raw binary")
    assert events.with_strict_event(rows, max_event_bytes=len(raw)).first()["reject_reason"] is None
    assert events.with_strict_event(rows, max_event_bytes=len(raw) - 1).first()["reject_reason"] == "oversize"


def message(content, role="user", kind="message", timestamp="2024-01-01T00:00:00Z") -> dict:
    return {"timestamp": timestamp, "type": "response_item", "payload": {"type": kind, "role": role, "content": content}}


MESSAGES = [
    (message("text"), "text"),
    (message(" \t "), None),
    (message(""), None),
    (message(5), None),
    (message(None), None),
    (message({"text": "in object"}), "in object"),
    (message({"text": 7}), None),
    (message([{"type": "input_text", "text": "a"}, {"type": "text", "text": "b"}]), "a\nb"),
    (message([{"type": "output_text", "text": "a"}, {"type": "image", "text": "no"}, "no", 3]), "a"),
    (message([{"type": "output_text", "text": 5}]), None),
    (message([]), None),
    (message("x", role="system"), None),
    (message("x", kind="reasoning"), None),
    (message("x", role=None), None),
    ({"payload": "x"}, None),
    ({"payload": {"type": "message", "role": "assistant", "content": "no time"}}, "no time"),
    (message("number time", timestamp=12), "number time"),
    (message("a\x00b "), "ab"),
    (message("123"), "123"),
]


def lines_of(spark, objects):
    rows, start = [], 0
    for value in objects:
        raw = json.dumps(value).encode() + b"\n"
        rows.append(("log.jsonl", start, start + len(raw), bytearray(raw)))
        start += len(raw)
    return spark.createDataFrame(rows, "source string, byte_start long, byte_end long, raw binary")


def test_message_texts(spark):
    lines = lines_of(spark, [value for value, _ in MESSAGES])
    found = ledger.messages(ledger.parsed_events(lines)).orderBy("byte_start").collect()
    assert [row["text"] for row in found] == [text for _, text in MESSAGES]
    assert [row["supported"] for row in found] == [text is not None for _, text in MESSAGES]
    by_text = {row["text"]: row["captured_at"] for row in found}
    assert by_text["no time"] is None and by_text["number time"] is None
    assert by_text["text"] == "2024-01-01T00:00:00Z"


def test_rejects_fail_or_are_kept_apart(spark):
    lines = lines_of(spark, [message("ok")]).unionByName(
        spark.createDataFrame([("bad.jsonl", 0, 4, bytearray(b"{x}\n")), ("b.jsonl", 0, 1, bytearray(b" \n"))],
                              "source string, byte_start long, byte_end long, raw binary")
    )
    kept = ledger.parsed_events(lines, on_reject="quarantine")
    assert sorted((r["source"], r["reject_reason"]) for r in kept.select("source", "reject_reason").collect()) == [
        ("bad.jsonl", "malformed"), ("log.jsonl", None),
    ]
    with pytest.raises(Exception, match="bad.jsonl at byte 0"):
        ledger.ledger_records(lines).collect()


def test_closed_keys(spark):
    rows = spark.createDataFrame([('{"a":1,"b":2}',), ('{"a":1}',), ("[1]",), ('{"a":1,"b":2,"c":3}',)], "j string")
    found = rows.select(events.has_exact_keys(F.try_parse_json("j"), ("b", "a")).alias("ok")).collect()
    assert [row["ok"] for row in found] == [True, False, False, False]


def test_ledger_round_trip_and_rules(spark):
    records = ledger.ledger_records(lines_of(spark, [message("a\u2028b\x85c"), message('quote " \\ tab\t')]))
    back = ledger.from_json_lines(ledger.to_json_lines(records))
    assert sorted(map(str, back.collect())) == sorted(map(str, records.collect()))
    assert ledger.ledger_violations(records).count() == 0
    broken = records.withColumn("role", F.lit("model")).withColumn("text", F.lit(None).cast("string"))
    assert {r["rule"] for r in ledger.ledger_violations(broken).collect()} == {"role", "text"}
