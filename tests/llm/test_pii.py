"""Base spans against Python's regular expressions; added spans, redaction and long texts."""

from __future__ import annotations

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import pii

# The base patterns as they are stated.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base(text):
    found = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(part) > 255 for part in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(span for _, _, span in sorted(found))


BITS = [
    "a", "b.c", "@", ".", "1", "255", "256", "4", " ", "-", "+", "(", ")", "é", "😀", "4111 1111 1111 1111", "192.168.0.1",
    "x@y.z", "\n", "0", "%", "+1 (375) 555-4393", "a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "joe (at) mail (dot) com",
    "(375) 555-4393", "4111 1111 1111 1112", "2001:db8:0:0:0:0:0:1",
]


@pytest.fixture(scope="module")
def found(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 25))) for _ in range(2500)]
    rows = [(i, t, "x") for i, t in enumerate([*texts, None, "", texts[0]])]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    return pii.find(df).select(
        "doc_id", "text", pii.listing("base_spans").alias("base"), pii.listing("spans").alias("spans"),
        pii.redacted(F.col("text"), "spans").alias("redacted"),
    ).collect()


def test_base_spans(found):
    assert len(found) == 2503
    for r in found:
        assert r["base"] == base(r["text"])


def test_spans_hold_the_base_and_add_apart_from_it(found):
    added = 0
    for r in found:
        every = [s for s in r["spans"].split(",") if s]
        own = [s for s in r["base"].split(",") if s]
        assert set(own) <= set(every) and len(set(every)) == len(every)
        limits = [tuple(map(int, s.split(":")[1:])) for s in own]
        for s in set(every) - set(own):
            a, b = map(int, s.split(":")[1:])
            assert all(b <= x or y <= a for x, y in limits)
            added += 1
    assert added


def test_redaction_removes_all_spans(found):
    for r in found:
        if r["text"] is None:
            assert r["redacted"] is None
            continue
        cut, at = [], 0
        for s in (s.split(":") for s in r["spans"].split(",") if s):
            a, b = int(s[1]), int(s[2])
            if a >= at:
                cut += [r["text"][at:a], f"[{s[0].upper()}]"]
            at = max(at, b)
        assert r["redacted"] == "".join(cut) + r["text"][at:]


@pytest.mark.parametrize("text", ["1" * 300_000, "a" * 300_000, "a." * 150_000, "a@b.c " * 6_000, "5-" * 150_000])
def test_time_follows_the_text(spark, text):
    started = time.time()
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    pii.find(df).select(F.size("base_spans")).collect()
    assert time.time() - started < 60


def test_redact_keeps_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "mail a@b.cd now", 3), (2, None, 4), (1, "mail a@b.cd now", 3)], "doc_id long, text string, loose int")
    rows = pii.redact(df)
    assert rows.columns == df.columns
    assert sorted(map(tuple, rows.collect())) == [(1, "mail [EMAIL] now", 3), (1, "mail [EMAIL] now", 3), (2, None, 4)]
    assert pii.redact(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = pii.candidates(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_labelers_that_agree_are_found_reliable():
    good, bad = ((1, 1, 1, 0), (0, 5, 4, 0), 400), ((-1, 1, 0, -1), (0, 3, 4, 0), 300)
    noisy = ((1, -1, 1, 0), (4, 3, 4, 1), 20)
    chance, tables = pii._reliabilities([good, bad, noisy])
    assert chance[0] > 0.9 and chance[1] < 0.1
    assert tables[0][1][0] > tables[0][1][1]


def spans_in(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = pii.find(df).select("doc_id", pii.listing("base_spans").alias("base"), pii.listing("spans").alias("spans"))
    return {r["doc_id"]: (r["base"], r["spans"]) for r in found.collect()}


def test_failing_base_matches_are_never_added(spark):
    rng = random.Random(5)
    good = [f"phone +1 ({rng.randint(200, 899)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}" for _ in range(60)]
    good += [f"card 4111 1111 1111 1111 and mail a{n}@gmail.com host 8.8.{n}.1" for n in range(60)]
    bad = ["build 999.999.999.999 and card 4111 1111 1111 1112", "sha d41d8cd98f00b20498765432109876543210e9800998ecf8427e", "+12 345"]
    found = spans_in(spark, [*good, *bad])
    for number in range(len(good), len(good) + len(bad)):
        assert found[number] == ("", ""), bad[number - len(good)]


def plain_accepts(model, features):
    return model.bias is not None and model.bias + sum(t.get(f, 0.0) for t, f in zip(model.weights, features, strict=True)) > 0


def test_added_spans_against_a_plain_pass_over_the_candidates(spark):
    rng = random.Random(7)
    bits = [*BITS, "call (375) 555-4393 ", "ip 2001:0:1:2:3:4:5:6 ", "joe (at) gmail (dot) com ", "9" * 17 + " 4111 1111 1111 1111 "]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = pii.candidates(df)
    model = pii.fit(found)
    made = {r["doc_id"]: r["spans"] for r in pii.spans(found, model).select("doc_id", "spans").collect()}
    added = 0
    for r in found.collect():
        wanted = {tuple(s) for s in r["base_spans"]}
        own = list(wanted)
        for c in r["loose"]:
            free = all(c["end"] <= s or e <= c["start"] for s, _, e in own)
            if not pii.FORMS[c["features"][0]].base and c["votes"][0] == 1 and plain_accepts(model, c["features"]) and free:
                wanted.add((c["start"], c["kind"], c["end"]))
        assert [tuple(s) for s in made[r["doc_id"]]] == sorted(wanted)
        added += len(wanted) - len(own)
    assert added


def test_gazetteers(spark):
    cases = {
        "email": {"a@gmail.com": 1, "joe (at) web (dot) de": 1, "a@b.org": 0, "a@b.co": 0, "a@b.localhost": -1},
        "ip": {"8.8.8.8": 1, "10.1.2.3": -1, "172.20.1.1": -1, "172.32.1.1": 1, "192.0.2.9": -1, "240.0.0.1": -1, "2001:db8:0:0:0:0:0:1": -1, "2a00:1:2:3:4:5:6:7": 1},
        "card": {"4111 1111 1111 1111": 1, "4111 1111 1111 111": -1, "2221-0000-0000-0009": 1, "371449635398431": 1, "9999999999999995": -1},
        "phone": {"+1 (375) 555-4393": 1, "+1 375 555 439": -1, "+44 20 7946 0958": 1, "+999 123 456 789": -1, "(375) 555-4393": 1, "(175) 555-4393": -1},
    }
    for kind, values in cases.items():
        df = spark.createDataFrame([(v,) for v in values], "v string")
        found = {r["v"]: r["n"] for r in df.select("v", pii._listed(kind, F.col("v")).alias("n")).collect()}
        assert found == values


def test_columns_of_any_name_are_kept(spark):
    names = ["sure", "loose", "_all", "_row", "_text", "votes"]
    df = spark.createDataFrame([(1, "mail a@gmail.com", *names)], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    row = pii.find(df).first()
    assert [row[n] for n in names] == names and row["text"] == "mail a@gmail.com" and len(row["spans"]) == 1
    kept = pii.find(df, keep=lambda rows: rows.drop("text")).first()
    assert "text" not in kept and kept["sure"] == "sure"
