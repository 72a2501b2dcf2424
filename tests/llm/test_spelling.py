"""Variants against all pairs of a small vocabulary, and word counts against plain Python."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import spelling


def near(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute(numbers, ratio=10):
    beside = {w: [x for x in numbers if x != w and near(w, x)] for w in numbers}
    form = {}
    for w in numbers:
        best = min(beside[w], key=lambda x: (-numbers[x], x), default=None)
        form[w] = best if best is not None and numbers[best] >= ratio * numbers[w] else None
    found = {}
    for w in numbers:
        root = w
        while form[root]:
            root = form[root]
        found[w] = (numbers[w], len(beside[w]), form[w], numbers[form[w]] if form[w] else None, root)
    return found


def vocabulary(seed, letters, most, size=300):
    rng = random.Random(seed)
    numbers = [1, 2, 5, 10, 20, 50, 100, 1000, 10_000]
    return {"".join(rng.choice(letters) for _ in range(rng.randint(1, most))): rng.choice(numbers) for _ in range(size)}


def found_by(spark, numbers, **options):
    df = spark.createDataFrame(list(numbers.items()), "word string, n long")
    return {
        r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"])
        for r in spelling.variants(df, **options).collect()
    }


@pytest.mark.parametrize("long", [64, 5, 1])
def test_against_all_pairs(spark, long):
    numbers = vocabulary(long, "abé", 8)
    assert found_by(spark, numbers, long=long) == brute(numbers)


def test_repeated_letters_and_chains(spark):
    numbers = {"aaa": 1, "aaaa": 10, "aaaaa": 100, "aaaaaa": 1000, "aaaaab": 9, "aaaaac": 9, "zz": 4}
    found = found_by(spark, numbers, long=4)
    assert found == brute(numbers)
    assert found["aaa"][4] == "aaaaaa"


def test_ratio(spark):
    numbers = {"word": 10, "worde": 29, "wort": 30}
    assert found_by(spark, numbers, ratio=3) == brute(numbers, 3)
    assert found_by(spark, numbers, ratio=3)["word"][2] == "wort"


def test_very_long_words(spark):
    word = "ab" * 20_000
    numbers = {word: 100, word[:-1]: 2, "x" + word[1:]: 1, "a" * 10_000: 1, "a" * 10_001: 50}
    found = found_by(spark, numbers)
    assert found[word] == (100, 2, None, None, word)
    assert found[word[:-1]] == (2, 1, word, 100, word)
    assert found["x" + word[1:]] == (1, 1, word, 100, word)
    assert found["a" * 10_000] == (1, 1, "a" * 10_001, 50, "a" * 10_001)


def test_edges(spark):
    rows = [("one", 5, "x"), ("one", 5, "y"), (None, 3, "x"), ("onee", None, "x"), ("", 4, "z")]
    df = spark.createDataFrame(rows, "word string, n long, key string")
    found = {r["word"]: (r["n"], r["n_near"], r["form"], r["root"]) for r in spelling.variants(df).collect()}
    assert found == {"one": (10, 1, None, "one"), "onee": (0, 1, "one", "one")}
    assert spelling.variants(df.limit(0)).count() == 0
    with pytest.raises(Exception, match="terminator"):
        spelling.variants(spark.createDataFrame([("a$b", 1)], "word string, n long")).collect()


def test_counted_words(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["Spelling", "spelling", "ÉTÉétéé", "short", "wordword1wordword", "x"]) for _ in range(60)) for _ in range(30)]
    texts += [None, "", "spelling" * 5000 + " spelling" * 5000]
    rows = [(k if k % 7 else None, text, "a", "b") for k, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, run string, id string")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            check = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if check % 31 == 0:
                at = check % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    expected = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    assert {r["word"]: r["n"] for r in spelling.counted_words(df).collect()} == expected
    plain = spelling.counted_words(df, misspelt=0, least_length=5).where(F.col("word") == "short").first()
    assert plain["n"] == sum(t.split(" ").count("short") for t in texts if t)
