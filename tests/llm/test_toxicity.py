"""Words and maxima against plain loops, gradients against differences, and held-out detection."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import toxicity

TEXTS = ["Big CLOWN, big", None, "", "clown clöwn", "!!! 12", "a" * 50 + " bb", "one\ntwo three-four"]


def small_network(seed=1):
    rng = np.random.default_rng(seed)
    tables = [rng.standard_normal((1 << bits, toxicity.PART)).astype(np.float32) for bits in toxicity.BITS]
    filters = rng.standard_normal((len(toxicity.BITS) * toxicity.PART, toxicity._COLUMNS)).astype(np.float32)
    size = len(toxicity.WIDTHS) * toxicity.FILTERS
    return toxicity.Network(0.5, tables, filters, rng.standard_normal(size).astype(np.float32), rng.standard_normal(size))


def plain_maxima(network, codes):
    """Each window as one long vector against each filter."""
    embedded = toxicity._embedded(network.tables, codes)
    found = []
    for width in toxicity.WIDTHS:
        for f in range(toxicity.FILTERS):
            start = toxicity._STARTS[width]
            weights = np.concatenate([network.filters[:, start + k * toxicity.FILTERS + f] for k in range(width)])
            windows = [embedded[i : i + width].ravel() @ weights for i in range(len(codes) - width + 1)]
            found.append(max(windows, default=-np.inf))
    return np.maximum(np.array(found) + network.bias, 0)


def test_words_are_runs_of_letters():
    codes, begins = toxicity.coded(pa.array(TEXTS))
    assert np.diff(begins).tolist() == [3, 0, 0, 2, 0, 2, 4]
    assert codes[0] == codes[2] and codes[1] == codes[3] and codes[3] != codes[4]
    word, first, second = toxicity._unpacked(toxicity.coded(pa.array(["lowering lowei loweriest low"]))[0])
    assert len(set(word)) == 4 and first[0] == first[1] == first[2] != first[3] and second[0] == second[2] != second[1]


def test_pieces_change_nothing(monkeypatch):
    texts = [" ".join(t for t in TEXTS if t), *TEXTS]
    whole = toxicity.coded(pa.array(texts))
    monkeypatch.setattr(toxicity, "PIECE", 60)
    parts = toxicity.coded(pa.array(texts))
    assert np.array_equal(whole[0], parts[0]) and np.array_equal(whole[1], parts[1])
    network = small_network()
    expected = network.maxima(*whole)
    monkeypatch.setattr(toxicity, "BLOCK_WORDS", 2)
    assert np.allclose(network.maxima(*whole), expected, atol=1e-4)
    for k in range(len(texts)):
        own = whole[0][whole[1][k] : whole[1][k + 1]]
        assert np.allclose(expected[k], plain_maxima(network, own), atol=1e-4)


def test_gradient_moves_against_the_loss():
    network = small_network(3)
    rng = np.random.default_rng(5)
    texts = [toxicity.coded(pa.array([" ".join(rng.choice(["aa", "bb", "cc", "dd"], 6))]))[0] for _ in range(8)]
    labels = np.array([0, 1] * 4)

    def loss(last):
        logits = np.concatenate([network.maxima(t, np.array([0, len(t)])) for t in texts]) @ last
        return toxicity._loss(logits, labels)

    class Kept:
        def __init__(self, weights):
            self.weights = weights

        def move(self, slopes):
            self.slopes = slopes

    shift = np.zeros(1)
    kept = Kept([network.filters, network.bias, network.last, shift])
    squares = [np.full(1 << bits, 1e9, np.float32) for bits in toxicity.BITS]
    toxicity._learn([t.copy() for t in network.tables], squares, kept, texts, labels)
    slope = kept.slopes[2] - 1e-3 * network.last
    for k in range(0, len(slope), 5):
        step = np.zeros(len(slope))
        step[k] = 1e-4
        assert np.isclose((loss(network.last + step) - loss(network.last - step)) / 2e-4, slope[k], atol=1e-3)


def made_texts(seed, count):
    rng = random.Random(seed)
    stems = ["gran", "velo", "mir", "tost", "pelu", "cor"]
    rows = []
    for k in range(count):
        words = [rng.choice(stems) + rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(rng.randint(5, 60))]
        toxic = k % 4 == 0
        if toxic:
            for _ in range(2):
                words[rng.randrange(len(words))] = "scumb" + rng.choice("abcdefgh") * rng.randint(1, 3)
        rows.append((k, " ".join(words), "xx" if k % 2 else "yy", int(toxic)))
    return rows


def test_finds_forms_of_a_stem(spark):
    rows = made_texts(1, 900)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    labels = df.where("doc_id < 600").select("doc_id", "toxic")
    found = toxicity.score(df.drop("toxic"), labels).where("doc_id >= 600").collect()
    truth = {r[0]: r[3] for r in rows}
    assert sum((r["score"] >= 0.7) == truth[r["doc_id"]] for r in found) > 0.97 * len(found)
    assert sum(r["toxic"] == (truth[r["doc_id"]] == 1) for r in found) > 0.97 * len(found)
    assert len({r["threshold"] for r in found}) <= 3 and all(0 <= r["score"] <= 1 for r in found)


def test_language_only_chooses_the_threshold(spark):
    rows = made_texts(2, 400)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    source = df.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"), F.col("lang").alias("_lang"))
    network = toxicity.fit(source, df.select(F.col("doc_id").alias("_id"), F.col("toxic").alias("_label")))
    network.thresholds = {"xx": 0.2}
    network.threshold = 0.6
    chosen = df.select("lang", toxicity._threshold_of(network, F.col("lang")).alias("t")).distinct().collect()
    assert {(r["lang"], r["t"]) for r in chosen} == {("xx", 0.2), ("yy", 0.6)}
    assert np.array_equal(network.scores(pa.array([rows[0][1]])), network.scores(pa.array([rows[0][1]])))


def test_threshold_of_best_f1():
    assert toxicity._threshold(np.array([0.1, 0.4, 0.6, 0.9]), np.array([0, 0, 1, 1]), 0.7) == pytest.approx(0.6)


def test_held_out_detection(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    scored = toxicity.score(docs, labels.where(~held)).drop("toxic")
    rows = scored.join(labels.where(held), "doc_id").collect()
    hit = [r["score"] >= 0.7 for r in rows]
    toxic = [r["toxic"] == 1 for r in rows]
    assert sum(h and t for h, t in zip(hit, toxic, strict=True)) > 0.75 * sum(toxic)
    assert sum(h and not t for h, t in zip(hit, toxic, strict=True)) < 0.02 * (len(rows) - sum(toxic))


def test_edges(spark):
    schema = "doc_id long, text string, lang string, score string, _text string, id long"
    docs = spark.createDataFrame([(1, "a b", "x", "", "", 1), (2, None, None, "", "", 1), (2, None, None, "", "", 1), (None, "", "x", "", "", 1)], schema)
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    found = toxicity.score(docs, labels).collect()
    assert [r["score"] for r in found] == [0.5] * 4
    assert toxicity.score(docs.limit(0), labels).count() == 0
    both = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    assert toxicity.score(docs, both).count() == 4
    long = spark.createDataFrame([(1, "word " * 400_000, "x"), (2, "bad", "x")], "doc_id long, text string, lang string")
    assert toxicity.score(long, both).count() == 2


def test_learns_from_all_labelled_rows(spark):
    count = 20_500
    ids = spark.range(count).select(F.col("id").alias("_id"))
    source = ids.select("_id", F.concat(F.lit("word a"), F.lit(" bcd")).alias("_text"), F.lit("x").alias("_lang"))
    long = spark.createDataFrame([(count, "some word " * 600_000, "x")], source.schema)
    labelled = spark.range(count + 1).select(F.col("id").alias("_id"), (F.col("id") % 2).cast("int").alias("_label"))
    rows = toxicity._learned(source.union(long), labelled)
    found = rows.groupBy("label").agg(F.count_if(F.col("piece") == 0).alias("n"), F.sum("words").alias("words")).collect()
    overlaps = 2 * (rows.where("piece > 0").count())
    assert {r["label"]: r["n"] for r in found} == {0: count // 2 + 1, 1: count // 2}
    assert sum(r["words"] for r in found) == 3 * count + 1_200_000 + overlaps
    assert rows.select("part").distinct().count() == 2


def test_more_labels_than_are_sent_to_tasks(spark, monkeypatch):
    source = spark.range(-500, 1500).select(F.col("id").alias("_id"), F.lit("some text").alias("_text"), F.lit("x").alias("_lang"))
    labelled = spark.range(-900, 1400, 3).select(F.col("id").alias("_id"), F.lit(1).alias("_label"))
    expected = sorted(r["order"] for r in toxicity._learned(source, labelled).collect())
    monkeypatch.setattr(toxicity, "BROADCAST_IDS", 10)
    assert len(expected) == 633 and sorted(r["order"] for r in toxicity._learned(source, labelled).collect()) == expected
    chosen = labelled.select(F.xxhash64("_id").alias("_order"))
    let_through = source.where(toxicity._may_be_labelled(chosen)(F.xxhash64("_id"))).count()
    assert 633 <= let_through < 650


def test_parts_learn_one_network(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "PART_IDS", 150)
    rows = made_texts(4, 1200)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    labels = df.where("doc_id < 900").select("doc_id", "toxic")
    found = toxicity.score(df.drop("toxic"), labels).where("doc_id >= 900").collect()
    truth = {r[0]: r[3] for r in rows}
    assert sum((r["score"] >= 0.7) == truth[r["doc_id"]] for r in found) > 0.95 * len(found)


def test_moves_are_means_over_the_parts_that_moved_a_row():
    rows = [(0, 1, 1.0, [3, 7], [[2.0], [4.0]]), (0, 2, 3.0, [7], [[8.0]]), (-2, 1, 2.0, [0], [[0.5]]), (-2, 2, 2.0, [0], [[1.5]])]
    batch = toxicity._move_batch([(b, p, w, np.array(r), np.array(v)) for b, p, w, r, v in rows])
    found = [row for out in toxicity._means(iter([batch])) for row in out.to_pylist()]
    moves = {r["block"]: [x.ravel().tolist() for x in toxicity._values_of(r["block"], r["rows"], r["moves"])] for r in found}
    assert moves == {0: [[3, 7], [2.0, 7.0]], -2: [[0], [1.0]]}
    assert found[1]["weight"] == 4.0
