"""Measures of the quality rules against plain Python."""

from __future__ import annotations

import random
import re

from ledgerloom.llm import rules
from tests.llm.test_words import plain


def brute(text):
    found = plain(text, lower=False)
    windows = {}
    for i in range(len(found) - 4):
        windows.setdefault(tuple(found[i : i + 5]), []).append(i)
    covered = {i + k for starts in windows.values() if len(starts) > 1 for i in starts for k in range(5)}
    lines = [line for line in (text or "").split("\n") if plain(line)]
    return (
        len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)), len(covered),
    )


def texts():
    rng = random.Random(4)
    pool = ["the", "a", "é", "😀b", "x#", "the", "*", "lines"]
    made = ["".join(rng.choice(pool) + rng.choice([" ", "\n", "  ", "\t"]) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    return [*made, None, "", " \n ", "a", "a b c d e", "a b c d e a b c d e", "a " * 30, "one line\n" * 4, "long " * 20_000]


def test_measures_and_edges(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, kept string")
    found = {r["doc_id"]: r for r in rules.judge(df).collect()}
    assert len(found) == len(rows)
    for i, text in rows:
        r = found[i]
        measures = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert measures == brute(text), text
        failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    assert rules.judge(df.limit(0)).count() == 0


def test_clean_keeps_rows_as_they_are(spark):
    good = "the house of the man is in the old town and it was built by his father in that year"
    df = spark.createDataFrame([(1, good, 5), (2, None, 6), (1, good, 5), (None, good, 7)], "doc_id long, text string, n_words int")
    assert sorted(map(tuple, rules.clean(df).collect()), key=str) == sorted([(1, good, 5), (1, good, 5), (None, good, 7)], key=str)


def test_stop_words_count_in_languages_that_have_some(spark):
    italian = " ".join(f"parola{i} nuova{i}" for i in range(40))
    capitals = " ".join(f"THE HOUSE{i} OF MAN{i}" for i in range(20))
    rows = [
        (1, italian, "it"), (2, italian, None), (3, italian, "en"), (4, italian, "EN-us"), (5, italian, "enm"),
        (6, capitals, "en"), (7, capitals.lower(), "en_GB"), (8, "word", "it"), (9, italian, ""),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert sorted(r["doc_id"] for r in rules.clean(df).collect()) == [1, 2, 5, 6, 7, 9]
    # Without languages the rule holds for every text, as in the query's check.
    assert sorted(r["doc_id"] for r in rules.clean(df.drop("lang")).collect()) == [7]


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = rules.judge(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_columns_of_any_name_are_kept(spark):
    names = ["__n_words", "_words", "_lines", "_stops", "_row", "_text", "_lang", "__words"]
    df = spark.createDataFrame([(1, "the word " * 20, *names)], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    row = rules.judge(df).first()
    assert [row[n] for n in names] == names and row["n_words"] == 40
    replaced = rules.judge(df.withColumnRenamed("_words", "n_words")).first()
    assert replaced["n_words"] == 40


def test_language_decides_on_the_stop_word_rule(spark):
    text = " ".join(f"ord{i}" for i in range(80))
    df = spark.createDataFrame([(1, text, "sv"), (2, text, "en-GB"), (3, text, None), (4, "THE " + text, "de"), (5, "THE AND " + text, "de")], "doc_id long, text string, lang string")
    found = {r["doc_id"]: r["kept"] for r in rules.judge(df, lang="lang").collect()}
    assert found == {1: True, 2: False, 3: True, 4: True, 5: True}
