from __future__ import annotations

import html
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import hygiene, ident, routes, text

ALPHABET = "ab \t\n\r\x0b\x1c\x85\xa0 　​‮éßñ日本語\U0001f600…&<>*_`[]|.\x00é"


def samples(count: int = 300, longest: int = 60) -> list[str]:
    rng = random.Random(7)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(longest))) for _ in range(count)]


def evaluate(spark, values, **columns):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    found = rows.select("i", *[c.alias(n) for n, c in columns.items()]).collect()
    return [row for row in sorted(found, key=lambda row: row["i"])]


def cut_bytes(value: str, limit: int) -> str:
    if len(value.encode()) <= limit:
        return value
    if limit < 3:
        return ""
    best = max(n for n in range(len(value) + 1) if len(value[:n].encode()) <= limit - 3)
    return value[:best].rstrip() + "…"


def one_line(value: str) -> str:
    return re.sub(r"\s+", " ", value).strip()


def escape(value: str) -> str:
    return "".join("\\" + c if c in r"\`*_{}[]<>()#+-.!|" else c for c in html.escape(value, quote=False))


@pytest.mark.parametrize("limit", [0, 2, 3, 4, 7, 20, 33])
def test_truncate_utf8(spark, limit):
    values = samples()
    found = evaluate(spark, values, out=text.truncate_utf8(F.col("t"), limit))
    assert [row["out"] for row in found] == [cut_bytes(v, limit) for v in values]


def test_truncate_keeps_null(spark):
    assert evaluate(spark, [None], out=text.truncate_utf8(F.col("t"), 5))[0]["out"] is None


def test_bounded_text(spark):
    values = samples(100, 200)
    found = evaluate(spark, values, out=text.bounded_text(F.col("t"), 64))
    for value, row in zip(values, found, strict=True):
        cleaned = value.replace("\x00", "").strip()
        wanted = cleaned if len(cleaned) <= 64 else cleaned[:44] + "\n[truncated locally]"
        assert row["out"] == wanted
    with pytest.raises(ValueError):
        text.bounded_text(F.col("t"), 63)


def test_excerpt_escapes_before_cutting(spark):
    values = [*samples(), "a & b" * 20, "<script>[x](javascript:y)</script>", "# head\n  > quote"]
    found = evaluate(
        spark, values, short=text.excerpt(F.col("t"), 24), whole=text.inert_markdown(F.col("t"))
    )
    for value, row in zip(values, found, strict=True):
        visible = re.sub("[\u200b-\u200f\u202a-\u202e\u2066-\u2069]", "", value)
        assert row["short"] == cut_bytes(escape(one_line(visible)), 24)
        kept = "".join(
            c
            for c in unicodedata.normalize("NFC", value)
            if not re.match("[\x00-\x08\x0b\x0c\x0e-\x1f\x7f\u200b-\u200f\u202a-\u202e\u2066-\u2069]", c)
        )
        assert row["whole"] == escape(one_line(kept))


def test_safe_text(spark):
    cases = {
        "plain": True,
        "two\nlines": True,
        "  ": False,
        "": False,
        "é composed": True,
        "e\u0301 decomposed": False,
        "zero\u200bwidth": False,
        "bell\x07": False,
        "日本語" * 4: False,
        None: False,
    }
    values = list(cases)
    found = evaluate(spark, values, out=text.is_safe_text(F.col("t"), 30))
    assert [row["out"] for row in found] == list(cases.values())
    single = evaluate(spark, ["two\nlines", "tab\t", "one"], out=text.is_safe_text(F.col("t"), 30, 10, True))
    assert [row["out"] for row in single] == [False, False, True]


def test_identifiers(spark):
    values = ["a", "-a", "a-", "a-b", "A", "a" * 64, "a" * 65, "a\n", "f" * 64, "f" * 32, "ultra"]
    found = evaluate(
        spark,
        values,
        slug=ident.is_slug(F.col("t")),
        hex64=ident.is_hex64(F.col("t")),
        hex32=ident.is_hex32(F.col("t")),
        effort=ident.is_effort(F.col("t")),
    )
    slugs = [v for v, row in zip(values, found, strict=True) if row["slug"]]
    assert slugs == ["a", "a-b", "a" * 64, "f" * 64, "f" * 32, "ultra"]
    assert [row["hex64"] for row in found].count(True) == 2
    assert [row["hex32"] for row in found].count(True) == 1
    assert [row["effort"] for row in found].count(True) == 1


def test_canonical_paths(spark):
    cases = {
        "a/b.md": True, "a": True, "": False, "/a": False, "a//b": False, "a/": False, "./a": False,
        "a/../b": False, "a\\b": False, "a\tb": False, "\u00e9": True, "e\u0301": False, "x" * 1025: False,
    }
    found = evaluate(spark, list(cases), out=routes.is_canonical_path(F.col("t")))
    assert [row["out"] for row in found] == list(cases.values())


def test_targets(spark):
    shapes = [
        ("xltm", None, None, None, True, None),
        ("xltm", "t", None, None, False, None),
        ("ltm", "t", None, None, True, "xltm///"),
        ("ltm", None, None, None, False, "xltm///"),
        ("mtm", "t", "b", None, True, "ltm/t//"),
        ("mtm", "t", "b", "l", False, "ltm/t//"),
        ("stm", "t", "b", "l", True, "mtm/t/b/"),
        ("stm", "t", "B!", "l", False, "mtm/t/B!/"),
        ("other", "t", "b", "l", False, None),
    ]
    rows = spark.createDataFrame(
        [(i, *shape) for i, shape in enumerate(shapes)],
        "i int, layer string, tree string, branch string, leaf string, ok boolean, parent string",
    )
    target = F.struct("layer", "tree", "branch", "leaf")
    checked = rows.select(
        "ok", routes.is_valid_target(target).alias("valid"), "parent",
        routes.parent_key(routes.target_key(target)).alias("found"),
    ).collect()
    assert all(row["ok"] == row["valid"] and row["parent"] == row["found"] for row in checked)


def test_private_data(spark):
    values = [
        "see /Users/ann/x", "see /home/bob/x", "key sk-" + "a1" * 8, "id 123E4567-e89b-12d3-a456-426614174000",
        "sk-short", "/home/", "nothing",
    ]
    found = evaluate(spark, values, out=hygiene.first_hit(hygiene.private_pattern_hits(F.col("t"))))
    assert [row["out"] for row in found] == [
        "mac_home_path", "linux_home_path", "secret_key", "uuid", None, None, None,
    ]
    paths = ["a/state.json", "state.json/b", "x.packet.json", "handoffs/y", "y/handoffs", "ok.md"]
    names = evaluate(spark, paths, out=hygiene.is_private_artifact(F.col("t")))
    assert [row["out"] for row in names] == [True, False, True, True, False, False]


def test_casefold(spark):
    values = ["Straße", "STRASSE", "Σίσυφος", "ﬁx", "Plain/Path", "É"]
    found = evaluate(spark, values, out=text.casefold(F.col("t")))
    assert [row["out"] for row in found] == [value.casefold() for value in values]


def test_excerpt_reads_no_more_than_it_needs(spark):
    rng = random.Random(6)
    bits = ["a", "é", "<", "*", " ", "  ", "\n", "\u200b", "\u2028", "\x85", "😀"]
    values = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 80))) for _ in range(400)] + ["", " \n", "\u200b" * 9]
    df = spark.createDataFrame([(v,) for v in values], "t string")

    def whole(column):
        visible = F.regexp_replace(column, text.INVISIBLE_CLASS, "")
        return text.truncate_utf8(text.escape_markdown(text.collapse_whitespace(visible)), 24)

    wrong = df.where(text.excerpt(F.col("t"), 24) != whole(F.col("t")))
    assert wrong.count() == 0
