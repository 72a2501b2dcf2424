"""Quality scores of texts from random-indexing word vectors and a small network.

Every word has a sparse random index vector of a few plus and minus ones, given by its
hash. A word's vector is the sum of the index vectors of its neighbours in the whole corpus;
words share a fixed number of rows by hash, so the table of vectors has a fixed size
whatever the vocabulary. Sums are whole numbers, so they do not depend on the order of
tasks. A text is the mean and the spread of its word vectors and how alike neighbouring
words are. A network of two layers, trained on labelled rows, gives a score, and a
temperature fitted on rows it was not trained on makes the score a probability.

The corpus statistics cover all texts. The network is fitted on at most ``MOST_LABELLED``
rows, those with the smallest hashes.

Defined results: a null or empty text, or one without words, has all-zero features and gets the score
of such a text; labels that are null, and rows with several different labels, are not
learned from; without labels of both classes every score is the share of label 1, or 0.5
without any; repeated rows each get a score; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import words
from ledgerloom.llm.store import by_group

ROWS = 1 << 14
WIDTH = 64
NONZERO = 4
WINDOW = 2
RANGES = 64
BLOCK_WORDS = 1 << 17
TEXT_BYTES = 2 << 20
MOST_LABELLED = 20_000
HIDDEN = 32
EPOCHS = 60
SEED = 7
FEATURES = 2 * WIDTH + 3


def _rows_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - 14)).astype(np.int64)


def _count(context: np.ndarray, hashes: np.ndarray, text: np.ndarray) -> None:
    """Add the index vectors of neighbours to the rows of words."""
    row = _rows_of(hashes)
    for step in range(1, WINDOW + 1):
        same = np.flatnonzero(text[step:] == text[:-step])
        for word, other in ((same, same + step), (same + step, same)):
            seen = hashes[other]
            for k in range(NONZERO):
                place = ((seen >> np.uint64(7 * k)) & np.uint64(WIDTH - 1)).astype(np.int64)
                sign = ((seen >> np.uint64(7 * k + 6)) & np.uint64(1)).astype(np.float64) * 2 - 1
                context += np.bincount(row[word] * WIDTH + place, sign, ROWS * WIDTH)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    context = np.zeros(ROWS * WIDTH)
    for batch in batches:
        texts = batch.column("_text")
        for start, stop in words.slices(texts):
            hashes, offsets = words.word_hashes(texts.slice(start, stop - start), lower=False)
            text = np.repeat(np.arange(stop - start), np.diff(offsets))
            for at in range(0, len(hashes), 4 * BLOCK_WORDS):
                # Neighbours reach into the next block, which then skips what was counted here.
                part = slice(max(0, at - WINDOW), at + 4 * BLOCK_WORDS)
                _count(context, hashes[part], text[part])
                if at:
                    edge = slice(max(0, at - WINDOW), at)
                    repeated = np.zeros(ROWS * WIDTH)
                    _count(repeated, hashes[edge], text[edge])
                    context -= repeated
    parts = context.reshape(RANGES, -1).astype("<i8")
    used = [r for r in range(RANGES) if parts[r].any()]
    narrow = [parts[r].astype("<i4") for r in used]
    yield pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()), pa.array([p.tobytes() for p in narrow], pa.binary())], names=["range", "body"]
    )


def _summed(group: pa.Table) -> pa.RecordBatch:
    total = np.zeros(ROWS * WIDTH // RANGES, np.int64)
    for body in group.column("body"):
        total += np.frombuffer(body.as_py(), "<i4")
    return pa.RecordBatch.from_arrays(
        [group.column("range").slice(0, 1).combine_chunks(), pa.array([total.astype("<i8").tobytes()], pa.binary())],
        names=["range", "body"],
    )


def word_vectors(source: DataFrame) -> np.ndarray:
    """The table of word vectors, each of length one or zero; its size is fixed."""
    sent = source.select("_text").mapInArrow(_contexts, "range int, body binary")
    rows = by_group(sent, ["range"], _summed, "range int, body binary").collect()
    table = np.zeros((RANGES, ROWS * WIDTH // RANGES))
    for row in rows:
        table[row["range"]] = np.frombuffer(row["body"], "<i8")
    vectors = table.reshape(ROWS, WIDTH)
    length = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return (vectors / np.maximum(length, 1e-9)).astype(np.float32)


def pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Features of each text from the vectors of all its words."""
    n = len(texts)
    sums, squares = np.zeros((n, WIDTH)), np.zeros((n, WIDTH))
    alike = np.zeros(n)
    hashes, offsets = words.word_hashes(texts, lower=False)
    text = np.repeat(np.arange(n), np.diff(offsets))
    row = _rows_of(hashes)
    for at in range(0, len(row), BLOCK_WORDS):
        own = text[at : at + BLOCK_WORDS]
        found = vectors[row[at : at + BLOCK_WORDS + 1]]
        block = found[: len(own)]
        cuts = np.flatnonzero(np.diff(own, prepend=-1))
        sums[own[cuts]] += np.add.reduceat(block, cuts, axis=0)
        squares[own[cuts]] += np.add.reduceat(block * block, cuts, axis=0)
        following = text[at + 1 : at + 1 + len(own)]
        pairs = np.flatnonzero(own[: len(following)] == following)
        cosines = np.einsum("ij,ij->i", found[pairs], found[pairs + 1])
        alike += np.bincount(own[pairs], cosines, n)
    counts = np.diff(offsets)[:, None]
    some = np.maximum(counts, 1)
    mean = sums / some
    spread = np.sqrt(np.maximum(squares / some - mean * mean, 0))
    more = np.stack(
        [alike / np.maximum(counts[:, 0] - 1, 1), np.sqrt((mean * mean).sum(axis=1)), np.log1p(counts[:, 0])], axis=1
    )
    return np.concatenate([mean, spread, more], axis=1).astype(np.float32)


@dataclass(frozen=True)
class Network:
    """Two layers over standardised features; without weights every score is ``share``."""

    share: float
    middle: np.ndarray | None = None
    scale: np.ndarray | None = None
    first: np.ndarray | None = None
    first_bias: np.ndarray | None = None
    second: np.ndarray | None = None
    second_bias: float = 0.0
    temperature: float = 1.0

    def logits(self, features: np.ndarray) -> np.ndarray:
        hidden = np.tanh((features - self.middle) / self.scale @ self.first + self.first_bias)
        return hidden @ self.second + self.second_bias

    def scores(self, features: np.ndarray) -> np.ndarray:
        if self.first is None:
            return np.full(len(features), self.share)
        return _sigmoid(self.logits(features.astype(np.float64)) / self.temperature)


def _sigmoid(values: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(values, -60, 60)))


def train(features: np.ndarray, labels: np.ndarray) -> Network:
    """Adam on four fifths of the rows; the best epoch and the temperature come from the rest."""
    share = float(labels.mean()) if len(labels) else 0.5
    if len(np.unique(labels)) < 2:
        return Network(share)
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(labels))
    features, labels = features[order].astype(np.float64), labels[order].astype(np.float64)
    held = max(1, len(labels) // 5)
    middle, scale = features.mean(axis=0), features.std(axis=0) + 1e-3
    x, y = (features[held:] - middle) / scale, labels[held:]
    weights = [
        rng.standard_normal((x.shape[1], HIDDEN)) / np.sqrt(x.shape[1]),
        np.zeros(HIDDEN),
        rng.standard_normal(HIDDEN) / np.sqrt(HIDDEN),
        np.zeros(1),
    ]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    best, best_loss, step = None, np.inf, 0
    for _ in range(EPOCHS):
        shuffled = rng.permutation(len(y))
        for start in range(0, len(y), 256):
            rows = shuffled[start : start + 256]
            hidden = np.tanh(x[rows] @ weights[0] + weights[1])
            error = (_sigmoid(hidden @ weights[2] + weights[3]) - y[rows]) / len(rows)
            back = np.outer(error, weights[2]) * (1 - hidden * hidden)
            slopes = [
                x[rows].T @ back + 1e-4 * weights[0],
                back.sum(axis=0),
                hidden.T @ error + 1e-4 * weights[2],
                np.array([error.sum()]),
            ]
            step += 1
            for w, (m, v), g in zip(weights, moments, slopes, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= 0.005 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        made = Network(share, middle, scale, *[w.copy() for w in weights[:3]], float(weights[3][0]))
        loss = _loss(made.logits(features[:held]), labels[:held])
        if loss < best_loss:
            best, best_loss = made, loss
    logits = best.logits(features[:held])
    temperatures = np.geomspace(0.25, 8, 61)
    fitted = min(temperatures, key=lambda t: _loss(logits / t, labels[:held]))
    return Network(share, middle, scale, best.first, best.first_bias, best.second, best.second_bias, float(fitted))


def _loss(logits: np.ndarray, labels: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, np.where(labels > 0.5, -logits, logits))))


def _pool_rows(vectors: np.ndarray):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in words.slices(batch.column("_text"), TEXT_BYTES):
                part = batch.slice(start, stop - start)
                features = pooled(part.column("_text"), vectors)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_order"), part.column("_label"), pa.array([f.tobytes() for f in features], pa.binary())],
                    names=["order", "label", "features"],
                )

    return apply


def _score_rows(vectors: np.ndarray, network: Network):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in words.slices(batch.column("_text"), TEXT_BYTES):
                part = batch.slice(start, stop - start)
                scores = network.scores(pooled(part.column("_text"), vectors))
                yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array(scores)], names=["id", "score"])

    return apply


def fit(source: DataFrame, labelled: DataFrame) -> tuple[np.ndarray, Network]:
    """Word vectors of all texts in ``source`` (_id, _text), and the network for labels (_id, _label)."""
    vectors = word_vectors(source)
    chosen = (
        labelled.where("_label IS NOT NULL AND _id IS NOT NULL")
        .groupBy("_id")
        .agg(F.min("_label").alias("_label"), F.max("_label").alias("_other"))
        .where("_label = _other")
        .withColumn("_order", F.xxhash64("_id"))
        .orderBy("_order", "_id")
        .limit(MOST_LABELLED)
        .select("_id", "_label", "_order")
    )
    # At most MOST_LABELLED rows, so sending them to every task is cheap.
    rows = (
        source.join(F.broadcast(chosen), "_id")
        .select("_order", "_label", "_text")
        .mapInArrow(_pool_rows(vectors), "order long, label int, features binary")
        .orderBy("order", "features")
        .limit(MOST_LABELLED)
        .collect()
    )
    features = np.array([np.frombuffer(r["features"], np.float32) for r in rows]).reshape(-1, FEATURES)
    return vectors, train(features, np.array([r["label"] for r in rows], np.int64))


def score(
    df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality"
) -> DataFrame:
    """(id, score) of every row of ``df``, learned from the given ``labels`` (id, label)."""
    source = df.select(F.col(id_column).cast("bigint").alias("_id"), F.col(text_column).alias("_text"))
    labelled = labels.select(F.col(id_column).cast("bigint").alias("_id"), F.col(label_column).cast("int").alias("_label"))
    vectors, network = fit(source, labelled)
    return source.mapInArrow(_score_rows(vectors, network), "id long, score double").withColumnRenamed("id", id_column)
