"""Word vectors against plain counting, the network's fit, and held-out accuracy."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerloom.llm import quality, words
from tests.llm.test_words import plain


def index_vector(value):
    vector = np.zeros(quality.WIDTH)
    for k in range(quality.NONZERO):
        vector[(value >> (7 * k)) & (quality.WIDTH - 1)] += 2 * ((value >> (7 * k + 6)) & 1) - 1
    return vector


def brute(texts):
    table = np.zeros((quality.ROWS, quality.WIDTH))
    for text in texts:
        hashes = words.word_hashes(pa.array([text], pa.string()), lower=False)[0].tolist()
        for i, word in enumerate(hashes):
            for j in range(max(0, i - quality.WINDOW), min(len(hashes), i + quality.WINDOW + 1)):
                if j != i:
                    table[word >> 50] += index_vector(hashes[j])
    return table / np.maximum(np.sqrt((table * table).sum(axis=1, keepdims=True)), 1e-9)


def small_texts():
    rng = random.Random(1)
    return [*[" ".join(rng.choice(["a", "b", "cc", "D"]) for _ in range(rng.randint(0, 30))) for _ in range(40)], None, "", "one"]


def test_word_vectors(spark):
    texts = small_texts()
    source = spark.createDataFrame(list(enumerate(texts)), "_id long, _text string").repartition(3)
    assert np.allclose(quality.word_vectors(source), brute(texts), atol=1e-5)


def test_blocks_change_nothing(monkeypatch):
    texts = pa.array([" ".join(t for t in small_texts() if t), *small_texts()])
    vectors = np.random.default_rng(1).standard_normal((quality.ROWS, quality.WIDTH)).astype(np.float32)
    batch = pa.RecordBatch.from_arrays([texts], names=["_text"])

    def both():
        counted = np.concatenate([np.frombuffer(b.as_py(), "<i4") for out in quality._contexts(iter([batch])) for b in out.column("body")])
        return counted, quality.pooled(texts, vectors)

    whole = both()
    monkeypatch.setattr(quality, "BLOCK_WORDS", 3)
    parts = both()
    assert np.array_equal(whole[0], parts[0])
    assert np.allclose(whole[1], parts[1], atol=1e-5)
    for row, text in enumerate(texts.to_pylist()):
        found = plain(text, lower=False)
        assert np.isclose(parts[1][row, -1], np.log1p(len(found)), atol=1e-5)
        if not found:
            assert not parts[1][row].any()


def test_network_learns_and_is_calibrated():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((3000, 10))
    y = ((x[:, 0] * x[:, 1] > 0) ^ (rng.random(3000) < 0.1)).astype(int)
    network = quality.train(x[:2000], y[:2000])
    scores = network.scores(x[2000:])
    assert ((scores >= 0.5) == y[2000:]).mean() > 0.8
    sure = scores > 0.8
    assert abs(scores[sure].mean() - y[2000:][sure].mean()) < 0.1


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    scored = quality.score(docs, labels.where(~held))
    rows = scored.join(labels.where(held), "doc_id").collect()
    right = sum((r["score"] >= 0.5) == (r["quality"] == 1) for r in rows)
    assert right / len(rows) > 0.95 and all(0 <= r["score"] <= 1 for r in rows)


def test_edges(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, None, "x"), (2, None, "x"), (None, "", "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None)], "doc_id long, quality int")
    assert {r["score"] for r in quality.score(docs, labels).collect()} == {0.5}
    assert quality.score(docs.limit(0), labels).count() == 0
    mixed = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    assert quality.score(docs, mixed).count() == 4


def test_ties_and_repeated_rows_have_equal_scores(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["aa", "bb", "cc", "dd"]) for _ in range(20)) for _ in range(40)]
    docs = spark.createDataFrame([(i % 30, texts[i % 40], "x") for i in range(80)], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)] * 2, "doc_id long, quality int")
    rows = quality.score(docs, labels).collect()
    again = quality.score(docs.repartition(5), labels).collect()
    assert len(rows) == 80 and sorted(map(tuple, rows)) == sorted(map(tuple, again))
    scores = {}
    for i, text in ((i % 30, texts[i % 40]) for i in range(80)):
        scores.setdefault((i, text), 0)
    assert len({(r["doc_id"], r["score"]) for r in rows}) <= len(scores)
