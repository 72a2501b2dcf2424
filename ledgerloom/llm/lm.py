"""Scores of texts under an interpolated bigram model, counted on the corpus itself.

Deleted interpolation: P(w | v) mixes the maximum-likelihood estimates c(v w) / c(v) and
c(w) / N and a uniform share 1 / (V + 1). The weights depend on how often the context v
was seen (one set for each power of two) and are learned by expectation-maximisation
on the counts of a held-back part of the training texts, with estimates from the other
part; the final estimates use both parts.

Counts are exact and cover all training texts; nothing but the weights, N and V passes the
driver. Texts become chunks of about a million tokens, stored once. A chunk sends
its distinct n-grams, sorted and split by hash range, as one packed block per range;
the range adds them up and answers with the n-grams that other chunks have too, which is
where its own counts are not the totals. So an n-gram is one number per chunk at most,
however often it occurs, and a chunk, a range or a text never needs more than its
share of memory.

Tokens: words between ASCII white space with A to Z lower-cased, and one end per text,
told apart by 64-bit hashes. Defined results: a null or empty text is one end token; a null
id counts as the empty string when the parts are dealt; repeated rows are counted and scored
each; without training texts every token has the uniform share; an empty table gives no
rows; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import words
from ledgerloom.llm.store import by_group, stored

CHUNK_TOKENS = 1_000_000
#: Distinct n-grams of one range, all chunks together, that a task adds up at once.
RANGE_NGRAMS = 2_000_000
BUCKETS = 48
EM_ROUNDS = 8
#: One training text in so many is held back for the weights.
HELD_BACK = 16
#: Tokens that the weights over all contexts count for in each bucket.
PRIOR = 50.0
END, BEGIN = np.uint64(0xE1D), np.uint64(0xB0)
_LEFT, _RIGHT = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)

_CHUNK = (
    "chunk string, tuning boolean, ids array<bigint>, held array<boolean>, lengths array<bigint>, "
    "vocabulary binary, tokens binary, n_tokens bigint, n_train bigint"
)
_SENT = "kind int, range int, chunk string, tuning boolean, body binary"
_ANSWER = "kind int, range int, chunk string, tuning boolean, body binary, known bigint"


@dataclass(frozen=True)
class Totals:
    tokens: int
    kept_tokens: int
    words: int


def _pack(*arrays: np.ndarray) -> bytes:
    """Unsigned numbers, each array with as many bytes a number as its largest needs, bytes of one rank together."""
    parts = []
    for array in arrays:
        values = np.ascontiguousarray(array, dtype="<u8")
        width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
        planes = values.view(np.uint8).reshape(-1, 8)[:, :width].T
        parts += [np.array([len(values), width], "<u8").tobytes(), np.ascontiguousarray(planes).tobytes()]
    return b"".join(parts)


def _unpack(body: bytes) -> list[np.ndarray]:
    arrays, at = [], 0
    while at < len(body):
        size, width = (int(x) for x in np.frombuffer(body, "<u8", 2, at))
        planes = np.frombuffer(body, np.uint8, size * width, at + 16).reshape(width, size)
        values = np.zeros((size, 8), np.uint8)
        values[:, :width] = planes.T
        arrays.append(values.view("<u8").reshape(size))
        at += 16 + size * width
    return arrays


def _deltas(ordered: np.ndarray) -> np.ndarray:
    return np.diff(ordered, prepend=np.uint64(0)) if len(ordered) else ordered


class _Texts:
    """Texts gathered for a chunk."""

    def __init__(self) -> None:
        self.ids, self.held, self.lengths, self.hashes, self.size = [], [], [], [], 0

    def add(self, ids: list, held: np.ndarray, counts: np.ndarray, hashes: np.ndarray) -> None:
        self.ids += ids
        self.held.append(held)
        self.lengths.append(counts)
        self.hashes.append(hashes)
        self.size += len(hashes) + len(ids)

    def chunk(self, name: str, tuning: bool) -> pa.RecordBatch:
        held, lengths = np.concatenate(self.held), np.concatenate(self.lengths)
        vocabulary, tokens = np.unique(np.concatenate(self.hashes), return_inverse=True)
        train = 0 if len(held) == 0 else int((lengths + 1)[~held].sum())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([name]),
                pa.array([tuning]),
                pa.array([self.ids], pa.list_(pa.int64())),
                pa.array([held.tolist()], pa.list_(pa.bool_())),
                pa.array([lengths.tolist()], pa.list_(pa.int64())),
                pa.array([_pack(_deltas(vocabulary))], pa.binary()),
                pa.array([_pack(tokens)], pa.binary()),
                pa.array([self.size], pa.int64()),
                pa.array([train], pa.int64()),
            ],
            names=["chunk", "tuning", "ids", "held", "lengths", "vocabulary", "tokens", "n_tokens", "n_train"],
        )


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    task, made = TaskContext.get().partitionId(), 0
    open_texts = {False: _Texts(), True: _Texts()}
    for batch in batches:
        for start, stop in words.slices(batch.column("_text")):
            part = batch.slice(start, stop - start)
            hashes, offsets = words.word_hashes(part.column("_text"))
            counts = np.diff(offsets)
            held = part.column("_held").to_numpy(zero_copy_only=False).astype(bool)
            tuning = part.column("_tuning").to_numpy(zero_copy_only=False).astype(bool)
            ids = part.column("_id").to_pylist()
            for side in (False, True):
                rows = np.flatnonzero(tuning == side)
                if len(rows) == 0:
                    continue
                chosen = np.repeat(tuning == side, counts)
                texts = open_texts[side]
                texts.add([ids[r] for r in rows], held[rows], counts[rows], hashes[chosen])
                if texts.size >= CHUNK_TOKENS:
                    yield texts.chunk(f"{task}-{made}", side)
                    made += 1
                    open_texts[side] = _Texts()
    for side, texts in open_texts.items():
        if texts.ids:
            yield texts.chunk(f"{task}-{made}", side)
            made += 1


@dataclass
class _Tokens:
    """A chunk's tokens: their words, contexts, bigrams and which count for training."""

    hashes: np.ndarray
    token: np.ndarray
    context: np.ndarray
    bigrams: np.ndarray
    bigram: np.ndarray
    train: np.ndarray
    text: np.ndarray


def _tokens(row: dict) -> _Tokens:
    vocabulary = np.cumsum(_unpack(row["vocabulary"])[0], dtype=np.uint64)
    own = _unpack(row["tokens"])[0].astype(np.int64)
    lengths = np.array(row["lengths"], np.int64)
    end, begin = len(vocabulary), len(vocabulary) + 1
    hashes = np.concatenate([vocabulary, [END, BEGIN]])
    ends = np.cumsum(lengths + 1) - 1
    token = np.full(len(own) + len(lengths), end, np.int64)
    is_word = np.ones(len(token), bool)
    is_word[ends] = False
    token[is_word] = own
    context = np.empty_like(token)
    context[1:] = token[:-1]
    context[ends - lengths] = begin
    keys = words.mix(hashes[context] * _LEFT + hashes[token] * _RIGHT)
    bigrams, bigram = np.unique(keys, return_inverse=True)
    text = np.repeat(np.arange(len(lengths)), lengths + 1)
    held = np.array(row["held"], bool)
    return _Tokens(hashes, token, context, bigrams, bigram, ~held[text], text)


def _own_counts(t: _Tokens, n_texts_train: int) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray | None]]:
    """For words and bigrams: sorted keys, training counts here, and each word's place among the keys."""
    word_counts = np.bincount(t.token[t.train], minlength=len(t.hashes))
    word_counts[-1] = n_texts_train
    order = np.argsort(t.hashes)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    pairs = np.bincount(t.bigram[t.train], minlength=len(t.bigrams))
    return [(1, t.hashes[order], word_counts[order], place), (2, t.bigrams, pairs, None)]


def _cuts(keys: np.ndarray, bits: int) -> np.ndarray:
    if bits == 0:
        return np.array([0, len(keys)])
    inner = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate([[0], np.searchsorted(keys, inner), [len(keys)]])


def _send(bits: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tokens = _tokens(row)
                for kind, keys, counts, _ in _own_counts(tokens, row["held"].count(False)):
                    cuts = _cuts(keys, bits)
                    used = np.flatnonzero(np.diff(cuts))
                    bodies = []
                    for r in used:
                        a, b = cuts[r], cuts[r + 1]
                        odd = np.flatnonzero(counts[a:b] != 1)
                        bodies.append(_pack(_deltas(keys[a:b]), odd, counts[a:b][odd]))
                    n = len(used)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([kind] * n, pa.int32()),
                            pa.array(used, pa.int32()),
                            pa.array([row["chunk"]] * n),
                            pa.array([row["tuning"]] * n),
                            pa.array(bodies, pa.binary()),
                        ],
                        names=["kind", "range", "chunk", "tuning", "body"],
                    )

    return apply


def _add_up(group: pa.Table) -> pa.RecordBatch:
    """Answers of one range: for each chunk the keys whose totals are not the chunk's own counts."""
    chunks, tuning = group.column("chunk").to_pylist(), group.column("tuning").to_pylist()
    keys, counts = [], []
    for body in group.column("body"):
        steps, odd, values = _unpack(body.as_py())
        keys.append(np.cumsum(steps, dtype=np.uint64))
        own = np.ones(len(steps), np.int64)
        own[odd.astype(np.int64)] = values
        counts.append(own)
    sizes = np.array([len(k) for k in keys])
    from_tuning = np.repeat(tuning, sizes)
    all_keys, all_counts = np.concatenate(keys), np.concatenate(counts)
    distinct, inverse = np.unique(all_keys, return_inverse=True)
    kept = np.bincount(inverse, np.where(from_tuning, 0, all_counts), len(distinct)).astype(np.int64)
    tuned = np.bincount(inverse, np.where(from_tuning, all_counts, 0), len(distinct)).astype(np.int64)
    kind = group.column("kind")[0].as_py()
    known = np.zeros(len(chunks), np.int64)
    known[0] = int(np.count_nonzero(kept + tuned)) if kind == 1 else 0
    bodies, at = [], 0
    for size, tune, own in zip(sizes, tuning, counts, strict=True):
        total = inverse[at : at + size]
        at += size
        mine, other = (tuned, kept) if tune else (kept, tuned)
        changed = np.flatnonzero((mine[total] != own) | (other[total] != 0))
        bodies.append(_pack(_deltas(changed.astype(np.uint64)), kept[total[changed]], tuned[total[changed]]))
    return pa.RecordBatch.from_arrays(
        [
            group.column("kind").combine_chunks(),
            group.column("range").combine_chunks(),
            pa.array(chunks),
            pa.array(tuning),
            pa.array(bodies, pa.binary()),
            pa.array(known),
        ],
        names=["kind", "range", "chunk", "tuning", "body", "known"],
    )


def _totals(rows: list[dict], bits: int) -> tuple[dict, _Tokens, dict]:
    """A chunk's tokens with the totals of their words and bigrams, from its own counts and the answers."""
    chunk = rows[0]
    tokens = _tokens(chunk)
    answers = {(row["kind"], row["range"]): row["body"] for row in rows[1:]}
    found = {}
    for kind, keys, counts, place in _own_counts(tokens, chunk["held"].count(False)):
        kept = np.zeros(len(keys), np.int64) if chunk["tuning"] else counts.copy()
        tuned = counts.copy() if chunk["tuning"] else np.zeros(len(keys), np.int64)
        cuts = _cuts(keys, bits)
        for r in np.flatnonzero(np.diff(cuts)):
            steps, k, t = _unpack(answers[kind, int(r)])
            at = np.cumsum(steps, dtype=np.uint64).astype(np.int64) + cuts[r]
            kept[at], tuned[at] = k, t
        found[kind] = (kept, tuned) if place is None else (kept[place], tuned[place])
    return chunk, tokens, found


def _bucket(context_counts: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else one more than the whole part of its count's logarithm."""
    exponent = np.frexp(context_counts.astype(np.float64))[1]
    return np.minimum(exponent, BUCKETS - 1)


def _estimates(pairs: np.ndarray, contexts: np.ndarray, counts: np.ndarray, total: int) -> tuple:
    seen = np.maximum(contexts, 1)
    return np.where(contexts > 0, pairs / seen, 0.0), counts / max(total, 1)


def _rows(group: pa.Table) -> list[dict]:
    return sorted(group.to_pylist(), key=lambda row: row["kind"])


def _held_back_estimates(bits: int, totals: Totals):
    def work(group: pa.Table) -> pa.RecordBatch | None:
        _, tokens, found = _totals(_rows(group), bits)
        word, pair = found[1][0], found[2][0]
        use = tokens.train
        contexts = word[tokens.context[use]]
        high, low = _estimates(pair[tokens.bigram[use]], contexts, word[tokens.token[use]], totals.kept_tokens)
        bucket = _bucket(contexts).astype(np.uint8)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([bucket.tobytes()], pa.binary()),
                pa.array([high.astype("<f4").tobytes()], pa.binary()),
                pa.array([low.astype("<f4").tobytes()], pa.binary()),
            ],
            names=["bucket", "high", "low"],
        )

    return work


def _expected(weights: np.ndarray, uniform: float):
    """Expected uses of each estimate in each bucket under the present weights."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((BUCKETS, 3))
        for batch in batches:
            for row in batch.to_pylist():
                bucket = np.frombuffer(row["bucket"], np.uint8)
                parts = weights[bucket] * np.stack(
                    [
                        np.frombuffer(row["high"], "<f4"),
                        np.frombuffer(row["low"], "<f4"),
                        np.full(len(bucket), uniform),
                    ],
                    axis=1,
                )
                parts /= parts.sum(axis=1, keepdims=True)
                for k in range(3):
                    sums[:, k] += np.bincount(bucket, parts[:, k], BUCKETS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(BUCKETS), pa.int32()), *[pa.array(sums[:, k]) for k in range(3)]],
            names=["bucket", "high", "low", "uniform"],
        )

    return apply


def _learn(held_back: DataFrame, totals: Totals) -> np.ndarray:
    """Weights (high, low, uniform) of each bucket."""
    weights = np.tile([0.5, 0.4, 0.1], (BUCKETS, 1))
    weights[0] = [0.0, 0.8, 0.2]
    for _ in range(EM_ROUNDS):
        rows = (
            held_back.mapInArrow(
                _expected(weights, 1 / (totals.words + 1)), "bucket int, high double, low double, uniform double"
            )
            .groupBy("bucket")
            .agg(F.sum("high"), F.sum("low"), F.sum("uniform"))
            .collect()
        )
        sums = np.zeros((BUCKETS, 3))
        for row in rows:
            sums[row[0]] = row[1:]
        if sums.sum() == 0:
            return weights
        overall = sums[1:].sum(axis=0) + 1e-9
        counted = sums + PRIOR * overall / overall.sum()
        counted[0] = sums[0] + PRIOR * np.array([0.0, 0.8, 0.2])
        counted[0, 0] = 0.0
        new = counted / counted.sum(axis=1, keepdims=True)
        change = np.abs(new - weights).max()
        weights = new
        if change < 1e-3:
            break
    return weights


def _scores(bits: int, totals: Totals, weights: np.ndarray):
    def work(group: pa.Table) -> pa.RecordBatch:
        chunk, tokens, found = _totals(_rows(group), bits)
        word, pair = found[1][0] + found[1][1], found[2][0] + found[2][1]
        contexts, counts = word[tokens.context], word[tokens.token]
        high, low = _estimates(pair[tokens.bigram], contexts, counts, totals.tokens)
        share = weights[_bucket(contexts)]
        chance = share[:, 0] * high + share[:, 1] * low + share[:, 2] / (totals.words + 1)
        base = np.log10((counts + 1) / (totals.tokens + totals.words + 1))
        n = len(chunk["ids"])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(chunk["ids"], pa.int64()),
                pa.array(chunk["held"], pa.bool_()),
                pa.array(np.array(chunk["lengths"], np.int64) + 1),
                pa.array(np.bincount(tokens.text, counts > 0, n).astype(np.int64)),
                pa.array(np.full(n, totals.tokens, np.int64)),
                pa.array(np.bincount(tokens.text, base, n)),
                pa.array(np.bincount(tokens.text, np.log10(chance), n)),
            ],
            names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    return work


def score(df: DataFrame, held_out: Column, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Score every text; rows where ``held_out`` is true are not learned from."""
    held = F.coalesce(held_out, F.lit(False))
    source = df.select(
        F.col(id_column).cast("bigint").alias("_id"),
        F.col(text_column).alias("_text"),
        held.alias("_held"),
        (~held & (F.pmod(F.xxhash64(F.col(id_column).cast("string")), F.lit(HELD_BACK)) == 0)).alias("_tuning"),
    )
    chunks = stored(source.mapInArrow(_chunks, _CHUNK), "chunks")
    sums = chunks.agg(
        F.sum("n_tokens"), F.sum("n_train"), F.sum(F.when(~F.col("tuning"), F.col("n_train")))
    ).first()
    bits = max(0, int(np.ceil(np.log2(max(1, (sums[0] or 0) / RANGE_NGRAMS)))))
    sent = chunks.mapInArrow(_send(bits), _SENT)
    answers = stored(by_group(sent, ["kind", "range"], _add_up, _ANSWER), "answers")
    known = answers.agg(F.sum("known")).first()[0] or 0
    # The begin mark is counted among the words if any text is for training; it is no token.
    totals = Totals(sums[1] or 0, sums[2] or 0, max(0, known - 1))
    empty = {"kind": F.lit(0), "range": F.lit(0), "body": F.lit(None).cast("binary")}
    columns = ["chunk", "kind", "range", "tuning", "body", "ids", "held", "lengths", "vocabulary", "tokens"]

    def meeting(tuning_only: bool) -> DataFrame:
        own = chunks.withColumns(empty).select(columns)
        theirs = answers.select(
            *[c if c in answers.columns else F.lit(None).cast(chunks.schema[c].dataType).alias(c) for c in columns]
        )
        both = own.union(theirs)
        return both.where("tuning") if tuning_only else both

    held_back = stored(
        by_group(
            meeting(True), ["chunk"], _held_back_estimates(bits, totals), "bucket binary, high binary, low binary"
        ),
        "held_back",
    )
    weights = _learn(held_back, totals)
    scored = by_group(
        meeting(False),
        ["chunk"],
        _scores(bits, totals, weights),
        "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
    return scored.withColumnRenamed("id", id_column)
