"""Scores of the interpolated model against a plain computation of the same model."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import lm
from tests.llm.test_words import plain

TYPES = "doc_id long, text string, score string"


def corpus(n=240):
    rng = random.Random(9)
    pool = [f"w{int(rng.paretovariate(0.7)) % 400}" for _ in range(900)]
    rows = [(i, " ".join(rng.choice(pool) for _ in range(rng.randint(0, 50))), "x") for i in range(n)]
    return [*rows, (n, None, None), (n + 1, "", None), (5, rows[5][1], "x"), (None, "w1 w2", None), (n + 2, "W1 \n unseenword", "x")]


def held_out():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2


def parts(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def brute(rows, tuning):
    """(base, score) by row, with the same expectation-maximisation over all tokens."""
    tokens = [[*plain(text), "</s>"] for _, text, _ in rows]
    kept, tuned = (
        [t for t, (i, _, _) in zip(tokens, rows, strict=True) if not parts(i) and (i in tuning) == side] for side in (False, True)
    )

    def counts(texts):
        words, pairs = Counter(), Counter()
        for text in texts:
            words.update(text)
            words["<s>"] += 1
            pairs.update(zip(["<s>", *text[:-1]], text, strict=True))
        return words, pairs

    (kw, kp), (tw, tp) = counts(kept), counts(tuned)
    words, pairs = kw + tw, kp + tp
    total = sum(words.values()) - words["<s>"]
    kept_total = sum(kw.values()) - kw["<s>"]
    known = len(words) - (1 if words["<s>"] else 0)

    def bucket(count):
        return min(math.frexp(count)[1], lm.BUCKETS - 1)

    stats = []
    for text in tuned:
        for v, w in zip(["<s>", *text[:-1]], text, strict=True):
            stats.append((bucket(kw[v]), kp[v, w] / max(kw[v], 1), kw[w] / max(kept_total, 1)))
    weights = np.tile([0.5, 0.4, 0.1], (lm.BUCKETS, 1))
    weights[0] = [0, 0.8, 0.2]
    for _ in range(lm.EM_ROUNDS):
        sums = np.zeros((lm.BUCKETS, 3))
        for b, high, low in stats:
            share = weights[b] * [np.float32(high), np.float32(low), 1 / (known + 1)]
            sums[b] += share / share.sum()
        if not stats:
            break
        overall = sums[1:].sum(axis=0) + 1e-9
        counted = sums + lm.PRIOR * overall / overall.sum()
        counted[0] = sums[0] + lm.PRIOR * np.array([0, 0.8, 0.2])
        counted[0, 0] = 0
        new = counted / counted.sum(axis=1, keepdims=True)
        change = np.abs(new - weights).max()
        weights = new
        if change < 1e-3:
            break
    out = []
    for text in tokens:
        base = sum(math.log10((words[w] + 1) / (total + known + 1)) for w in text)
        score = 0.0
        for v, w in zip(["<s>", *text[:-1]], text, strict=True):
            a, b, c = weights[bucket(words[v])]
            score += math.log10(a * (pairs[v, w] / words[v] if words[v] else 0) + b * words[w] / max(total, 1) + c / (known + 1))
        out.append((len(text), sum(words[w] > 0 for w in text), total, base, score))
    return out


@pytest.mark.parametrize(("chunk", "ranged"), [(1_000_000, 2_000_000), (300, 500)])
def test_scores_match_a_plain_model(spark, monkeypatch, chunk, ranged):
    monkeypatch.setattr(lm, "CHUNK_TOKENS", chunk)
    monkeypatch.setattr(lm, "RANGE_NGRAMS", ranged)
    rows = corpus()
    df = spark.createDataFrame(rows, TYPES)
    tuning = {
        r["doc_id"]
        for r in df.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(lm.HELD_BACK)) == 0).collect()
    }
    expected = brute(rows, tuning)
    found = sorted(lm.score(df, held_out()).collect(), key=lambda r: (str(r["doc_id"]), r["score"]))
    order = sorted(range(len(rows)), key=lambda k: (str(rows[k][0]), expected[k][4]))
    assert len(found) == len(rows)
    for r, k in zip(found, order, strict=True):
        n, known, total, base, score = expected[k]
        assert (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (rows[k][0], parts(rows[k][0]), n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] == pytest.approx(score, rel=1e-5)


def test_empty_and_untrained_tables(spark):
    df = spark.createDataFrame([(1, "a b", "x")], TYPES)
    assert lm.score(df.limit(0), held_out()).count() == 0
    only = lm.score(df, F.lit(True)).first()
    assert only["train_tokens"] == 0 and only["n_known"] == 0 and only["n_tokens"] == 3
    assert math.isfinite(only["score"])


def test_packed_numbers_come_back():
    rng = np.random.default_rng(1)
    arrays = [np.zeros(0, np.uint64), np.array([0], np.uint64), rng.integers(0, 1 << 63, 50, dtype=np.uint64), np.array([(1 << 64) - 1], np.uint64)]
    for a, b in zip(arrays, lm._unpack(lm._pack(*arrays)), strict=True):
        assert np.array_equal(a, b)
