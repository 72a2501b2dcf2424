"""Toxicity scores of texts from a convolutional classifier over hashed word embeddings.

A word is a run of letters in any case. Three hashes, of the whole word and of its first four and six letters, give
it a row in each of three tables of embeddings; the beginnings let forms of one stem share what is learned. Filters
of several widths slide over all words of a text; each filter keeps its largest value in the text, and a
logistic layer over these maxima gives the score. Everything is trained together, in numpy, on labelled rows: only
the words at a maximum get a gradient. A scale and a shift, fitted on a fifth of the rows that it was not
trained on, make the score a probability; on these rows a threshold is chosen for every language.

Rows of a table that fewer than ``LEAST_TEXTS`` training texts use stay zero, as for words that training
never saw.

All labelled rows are learned from. They are dealt into parts by the hash of their id, and stored as numbers of
words. In every epoch each part moves the same network on its own rows, and the next network is the mean of the
moves: of a row of a table over the parts that moved it. Moves are added up over the cluster by blocks of
rows, so the driver gets one network an epoch, however many parts there are; it keeps that of the least loss
on the fifth. A text of over ``PIECE_WORDS`` words is learned from in pieces. Scores read whole texts, in blocks.

Defined results: a null or empty text, or one without letters, has no maxima and gets the score of such a
text; labels that are null, and ids with several different labels, are not learned from; without labels of both
classes every score is the share of label 1, or 0.5 without any; a null or rare language has the
threshold of all; repeated rows each get a score; an empty table gives no rows; other columns
are not read; a run of over ``PIECE`` letters without a space counts as several words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import words
from ledgerloom.llm.store import stored
from ledgerloom.session import work_folder

#: Bits of a row number in the tables of words, of first four and of first six letters.
BITS = (18, 16, 16)
BEGINNINGS = (4, 6)
#: Parts of an embedding that come from each table.
PART = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
BLOCK_WORDS = 1 << 16
TEXT_BYTES = 1 << 20
PIECE = 1 << 20
#: Labelled ids in a part, and words after which a part is trained on as several.
PART_IDS = 12_000
PART_WORDS = 8_000_000
#: Labelled ids up to which they are sent to every task; beyond, texts that may be labelled are shuffled.
BROADCAST_IDS = 200_000
#: Bits of the filter that tells which texts may be labelled, and of one of its rows.
FILTER_BITS = 1 << 27
FILTER_ROW = 1 << 15
#: Words of one row to learn from; longer texts are several rows.
PIECE_WORDS = 1 << 18
#: One in so many ids is not trained on.
HELD = 5
#: Rows of the tables whose moves are added up together.
BLOCK_ROWS = 1 << 12
LEAST_TEXTS = 3
#: Words to train on, over all epochs.
TRAINED_WORDS = 40_000_000
EPOCHS = (6, 25)
BATCH = 64
DROPPED = 0.2
RATE = 0.1
SEED = 11
#: Held-back rows of either class that a language needs for a threshold of its own.
LEAST_HELD = 20
LEVELS = np.linspace(0.05, 0.95, 91)
#: Scales and shifts to choose from.
PAIRS = [(float(a), float(b)) for a in np.geomspace(0.25, 4, 25) for b in np.linspace(-2, 2, 21)]
#: Blocks of what is no row of a table: the dense weights, and the loss on held-back rows.
DENSE, LOSS = -1, -2

_KNOWN = 0x250
_LOWER = np.array([ord(chr(c).lower()) if chr(c).isalpha() and len(chr(c).lower()) == 1 else 0 for c in range(_KNOWN)], np.uint32)
#: Columns of a filter bank: for each width and place in the window, one for each filter.
_STARTS = {width: FILTERS * sum(w for w in WIDTHS if w < width) for width in WIDTHS}
_COLUMNS = FILTERS * sum(WIDTHS)


def _letters(text: str) -> np.ndarray:
    """Code points in lower case, 0 for all that is no letter; those beyond the Latin ones count as letters."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(points < _KNOWN, _LOWER[np.minimum(points, _KNOWN - 1)], points)


def _codes_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of every word, packed, and where it begins."""
    letters = _letters(text)
    inside = np.concatenate([[False], letters > 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = edges[::2], edges[1::2]
    if len(begin) == 0:
        return np.zeros(0, np.uint64), begin
    mixed = words.mix(letters)
    powers, inverse = words._powers(1 << max(10, int(len(letters) - 1).bit_length()))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed * powers[: len(letters)], dtype=np.uint64)])
    packed = np.zeros(len(begin), np.uint64)
    for bits, most in zip(BITS, (None, *BEGINNINGS), strict=True):
        stop = end if most is None else np.minimum(end, begin + most)
        hashes = words.mix((sums[stop] - sums[begin]) * inverse[begin] + (stop - begin).astype(np.uint64))
        packed = packed << np.uint64(bits) | hashes >> np.uint64(64 - bits)
    return packed, begin


def _pieces(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > PIECE:
        cut = text.rfind(" ", at, at + PIECE) + 1 or at + PIECE
        yield text[at:cut]
        at = cut
    yield text[at:] if at else text


def coded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of every word, packed into one number, and where each text's words begin (and end)."""
    begins = np.zeros(len(texts) + 1, np.int64)
    values = [text or "" for text in texts.to_pylist()]
    if sum(map(len, values)) <= PIECE:
        codes, begin = _codes_of("\n".join(values))
        ends = np.cumsum([len(value) + 1 for value in values])
        begins[1:] = np.searchsorted(begin, ends)
        return codes, begins
    found = []
    for k, value in enumerate(values):
        parts = [_codes_of(piece)[0] for piece in _pieces(value)]
        begins[k + 1] = begins[k] + sum(map(len, parts))
        found += parts
    return np.concatenate(found) if found else np.zeros(0, np.uint64), begins


def _unpacked(codes: np.ndarray) -> list[np.ndarray]:
    rows = []
    for bits in reversed(BITS):
        rows.insert(0, (codes & np.uint64((1 << bits) - 1)).astype(np.int64))
        codes = codes >> np.uint64(bits)
    return rows


@dataclass
class Network:
    """Embeddings, filters and the last layer; without filters every score is ``share``."""

    share: float
    tables: list[np.ndarray] | None = None
    filters: np.ndarray | None = None
    bias: np.ndarray | None = None
    last: np.ndarray | None = None
    shift: float = 0.0
    #: Scale and shift that make scores probabilities.
    calibration: tuple[float, float] = (1.0, 0.0)
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.7

    def maxima(self, codes: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Largest value of every filter in every text, not below zero."""
        texts = len(begins) - 1
        found = np.full((texts, len(WIDTHS) * FILTERS), -np.inf, np.float32)
        owner = np.repeat(np.arange(texts), np.diff(begins))
        reach = max(WIDTHS) - 1
        for at in range(0, len(codes), BLOCK_WORDS):
            part = codes[at : at + BLOCK_WORDS + reach]
            own = owner[at : at + BLOCK_WORDS + reach]
            values = _values(self.tables, self.filters, part)
            for k, width in enumerate(WIDTHS):
                usable = min(BLOCK_WORDS, len(part) - width + 1)
                if usable <= 0:
                    continue
                one_text = np.flatnonzero(own[:usable] == own[width - 1 : usable + width - 1])
                if len(one_text) == 0:
                    continue
                slid = _slide(values, width)[one_text]
                cuts = np.flatnonzero(np.diff(own[one_text], prepend=-1))
                into = (own[one_text][cuts], slice(k * FILTERS, (k + 1) * FILTERS))
                found[into] = np.maximum(found[into], np.maximum.reduceat(slid, cuts, axis=0))
        return np.maximum(found + self.bias, 0)

    def logits(self, codes: np.ndarray, begins: np.ndarray) -> np.ndarray:
        return self.maxima(codes, begins).astype(np.float64) @ self.last + self.shift

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.filters is None:
            return np.full(len(texts), self.share)
        scale, shift = self.calibration
        return _sigmoid(scale * self.logits(*coded(texts)) + shift)


def _sigmoid(values: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(values, -60, 60)))


def _embedded(tables: list[np.ndarray], codes: np.ndarray) -> np.ndarray:
    found = [table[rows] for table, rows in zip(tables, _unpacked(codes), strict=True)]
    return np.concatenate(found, axis=1).astype(np.float32)


def _values(tables: list[np.ndarray], filters: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """What each word adds to each filter at each place; equal words are computed once."""
    distinct = pa.array(codes).dictionary_encode()
    return (_embedded(tables, distinct.dictionary.to_numpy()) @ filters)[distinct.indices.to_numpy()]


def _slide(values: np.ndarray, width: int) -> np.ndarray:
    """Values of the filters of one width at every place where a window begins."""
    start, size = _STARTS[width], len(values) - width + 1
    total = values[:size, start : start + FILTERS]
    for k in range(1, width):
        total = total + values[k : k + size, start + k * FILTERS : start + (k + 1) * FILTERS]
    return total


class _Adam:
    def __init__(self, weights: list[np.ndarray], rate: float):
        self.weights, self.rate, self.step = weights, rate, 0
        self.moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]

    def move(self, slopes: list[np.ndarray]) -> None:
        self.step += 1
        for w, (m, v), g in zip(self.weights, self.moments, slopes, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= self.rate * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.999**self.step)) + 1e-8)


@dataclass
class _State:
    """What an epoch moves: rows of tables with their squares, dense weights and moments, and the steps taken."""

    tables: list[np.ndarray]
    squares: list[np.ndarray]
    weights: list[np.ndarray]
    moments: list[tuple[np.ndarray, np.ndarray]]
    step: int = 0

    def network(self, share: float) -> Network:
        filters, bias, last, shift = self.weights
        return Network(share, self.tables, filters, bias, last, float(shift[0]))

    def copy(self) -> _State:
        moments = [(m.copy(), v.copy()) for m, v in self.moments]
        return _State([t.copy() for t in self.tables], [q.copy() for q in self.squares], [w.copy() for w in self.weights], moments, self.step)

    def dense(self) -> np.ndarray:
        values = [*self.weights, *(part for pair in self.moments for part in pair), np.array([self.step])]
        return np.concatenate([v.ravel().astype(np.float64) for v in values])

    def rows(self) -> np.ndarray:
        """Rows of all tables, one table after the other, with their squares."""
        return np.column_stack([np.concatenate(self.tables), np.concatenate(self.squares)])

    def move(self, moves: dict[int, tuple[np.ndarray, np.ndarray]]) -> None:
        """Add the moves of each block."""
        whole = self.rows()
        for block, (rows, values) in moves.items():
            if block >= 0:
                whole[block * BLOCK_ROWS + rows] += values.astype(np.float32)
        cuts = np.cumsum([len(t) for t in self.tables])[:-1]
        self.tables = [np.ascontiguousarray(t) for t in np.split(whole[:, :PART], cuts)]
        self.squares = [np.ascontiguousarray(q) for q in np.split(whole[:, PART], cuts)]
        if DENSE in moves:
            dense = self.dense() + moves[DENSE][1][:, 0]
            for part in [*self.weights, *(part for pair in self.moments for part in pair)]:
                part[...] = dense[: part.size].reshape(part.shape)
                dense = dense[part.size :]
            self.step = round(float(dense[0]))


def _first_state(share: float, used: list[np.ndarray]) -> _State:
    """Random weights; ``used`` tells the rows of each table that enough texts use."""
    rng = np.random.default_rng(SEED)
    tables = [rng.standard_normal((len(use), PART)).astype(np.float32) * np.float32(0.1) * use[:, None] for use in used]
    squares = [np.where(use, 1e-3, np.inf).astype(np.float32) for use in used]
    filters = rng.standard_normal((len(BITS) * PART, _COLUMNS)).astype(np.float32) / np.float32(np.sqrt(len(BITS) * PART))
    bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
    last = rng.standard_normal(len(bias)) / np.sqrt(len(bias))
    weights = [filters, bias, last, np.array([np.log((share + 1e-3) / (1 - share + 1e-3))])]
    return _State(tables, squares, weights, [(np.zeros_like(w), np.zeros_like(w)) for w in weights])


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray], np.ndarray, np.ndarray]]:
    """Number, texts, labels and roles of each part in the task; a part of very many words as several."""
    part, held, texts, labels, roles = None, 0, [], [], []
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("part", "codes", "label", "role"))
        for own, codes, label, role in zip(*columns, strict=True):
            if texts and (own != part or held > PART_WORDS):
                yield part, texts, np.array(labels), np.array(roles)
                held, texts, labels, roles = 0, [], [], []
            part = own
            texts.append(np.frombuffer(codes, "<u8"))
            labels.append(label)
            roles.append(role)
            held += len(texts[-1]) + 16
    if texts:
        yield part, texts, np.array(labels), np.array(roles)


_MOVES = "block int, part int, weight double, rows binary, moves binary"


def _move_batch(moves: list[tuple[int, int, float, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    blocks, parts, weights, rows, values = zip(*moves, strict=True)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(blocks, pa.int32()),
            pa.array(parts, pa.int32()),
            pa.array(weights, pa.float64()),
            pa.array([r.astype("<i4").tobytes() for r in rows], pa.binary()),
            pa.array([v.astype("<f4" if b >= 0 else "<f8").tobytes() for b, v in zip(blocks, values, strict=True)], pa.binary()),
        ],
        names=["block", "part", "weight", "rows", "moves"],
    )


def _by_block(part: int, weight: float, rows: np.ndarray, values: np.ndarray) -> list[tuple]:
    """Moves of rows of the tables, numbered over all tables, cut into blocks."""
    blocks = rows // BLOCK_ROWS
    return [
        (int(block), part, weight, rows[blocks == block] % BLOCK_ROWS, values[blocks == block]) for block in np.unique(blocks)
    ]


def _values_of(block: int, rows: bytes, moves: bytes) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.frombuffer(rows, "<i4")
    values = np.frombuffer(moves, "<f4" if block >= 0 else "<f8")
    return numbers, values.reshape(len(numbers), -1)


def _means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The mean move of every row of each block, over those that moved it; ``weight`` counts for a part."""

    def mean() -> pa.RecordBatch:
        moved = np.flatnonzero(times)
        return _move_batch([(block, 0, float(times.max()), moved, total[moved] / times[moved, None])])

    block, total, times = None, None, None
    for batch in batches:
        for row in batch.to_pylist():
            numbers, values = _values_of(row["block"], row["rows"], row["moves"])
            if row["block"] != block:
                if block is not None:
                    yield mean()
                block = row["block"]
                size = BLOCK_ROWS if block >= 0 else len(numbers)
                total, times = np.zeros((size, values.shape[1])), np.zeros(size)
            total[numbers] += row["weight"] * values
            times[numbers] += row["weight"]
    if block is not None:
        yield mean()


def _collected(moves: DataFrame) -> dict[int, tuple[float, tuple[np.ndarray, np.ndarray]]]:
    """Largest weight, rows and mean moves of every block: as much as one network."""
    sorted_moves = moves.repartition("block").sortWithinPartitions("block", "part", "weight", "rows", "moves")
    found = sorted_moves.mapInArrow(_means, _MOVES).toArrow().to_pylist()
    return {r["block"]: (r["weight"], _values_of(r["block"], r["rows"], r["moves"])) for r in found}


def _uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every row of the tables that a part uses; the weight is one for each text, up to the number that matters."""
    offsets = np.cumsum([0, *(1 << bits for bits in BITS)])
    for part, texts, _, roles in _segments(batches):
        count = np.zeros(offsets[-1], np.int64)
        for text in (t for t, role in zip(texts, roles, strict=True) if role & 1):
            for offset, rows in zip(offsets, _unpacked(text), strict=False):
                count[offset + np.unique(rows)] += 1
        for least in range(1, LEAST_TEXTS + 1):
            rows = np.flatnonzero(count == least if least < LEAST_TEXTS else count >= least)
            if len(rows):
                # Moves whose sum over parts, weight times one, is the number of texts.
                yield _move_batch(_by_block(part, float(least), rows, np.ones((len(rows), 1), np.float32)))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each block that enough texts use."""

    def enough() -> pa.RecordBatch:
        rows = np.flatnonzero(times >= LEAST_TEXTS)
        return _move_batch([(block, 0, 1.0, rows, np.ones((len(rows), 1)))])

    block, times = None, None
    for batch in batches:
        for row in batch.to_pylist():
            if row["block"] != block:
                if block is not None:
                    yield enough()
                block, times = row["block"], np.zeros(BLOCK_ROWS)
            times[np.frombuffer(row["rows"], "<i4")] += row["weight"]
    if block is not None:
        yield enough()


def _used(rows: DataFrame) -> list[np.ndarray]:
    """Whether enough training texts use each row of each table."""
    offsets = np.cumsum([0, *(1 << bits for bits in BITS)])
    use = np.zeros(offsets[-1], bool)
    blocks = rows.mapInArrow(_uses, _MOVES).repartition("block").sortWithinPartitions("block")
    for row in blocks.mapInArrow(_counts, _MOVES).toArrow().to_pylist():
        use[row["block"] * BLOCK_ROWS + np.frombuffer(row["rows"], "<i4")] = True
    return np.split(use, offsets[1:-1])


def _trained(state: _State, texts: list[np.ndarray], labels: np.ndarray, rng: np.random.Generator) -> tuple[_State, int]:
    """The state after all texts were seen once, and the steps this took."""
    own = state.copy()
    adam = _Adam(own.weights, 0.003)
    adam.moments, adam.step = own.moments, own.step
    order = rng.permutation(len(texts))
    for start in range(0, len(order), BATCH):
        some = order[start : start + BATCH]
        kept = [texts[t][rng.random(len(texts[t])) >= DROPPED] for t in some]
        _learn(own.tables, own.squares, adam, kept, labels[some])
    steps = adam.step - state.step
    own.step = adam.step
    return own, steps


def _epoch(shared, epoch: int, learning: bool):
    """Moves of the shared state by each part's rows, and the loss of that state on the part's held-back rows."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = shared.value
        with np.errstate(invalid="ignore"):
            for number, (part, texts, labels, roles) in enumerate(_segments(batches)):
                moves = []
                held = np.flatnonzero(roles & 2)
                if len(held):
                    logits = state.network(0.5).logits(*_joined([texts[t] for t in held]))
                    moves.append((LOSS, part, float(len(held)), np.zeros(1), np.array([[_loss(logits, labels[held])]])))
                learned = np.flatnonzero(roles & 1)
                if learning and len(learned):
                    rng = np.random.default_rng([SEED, epoch, part, number])
                    own, steps = _trained(state, [texts[t] for t in learned], labels[learned], rng)
                    dense = own.dense() - state.dense()
                    moves.append((DENSE, part, float(steps), np.arange(len(dense)), dense[:, None]))
                    before, after = state.rows(), own.rows()
                    rows = np.flatnonzero(after[:, PART] != before[:, PART])
                    moves += _by_block(part, float(steps), rows, after[rows] - before[rows])
                if moves:
                    yield _move_batch(moves)

    return apply


def _run(rows: DataFrame, state: _State, epoch: int, learning: bool = True) -> dict[int, tuple[float, tuple]]:
    shared = rows.sparkSession.sparkContext.broadcast(state)
    found = _collected(rows.mapInArrow(_epoch(shared, epoch, learning), _MOVES))
    shared.destroy()
    return found


def _best_network(rows: DataFrame, share: float, count: int) -> Network:
    """The network of the epoch with the least loss on held-back rows; ``count`` words are trained on."""
    state = _first_state(share, _used(rows))
    best, best_loss = None, np.inf
    epochs = int(np.clip(TRAINED_WORDS // max(count, 1), *EPOCHS))
    for epoch in range(epochs + 1):
        # The loss is that of the state before the epoch.
        found = _run(rows, state, epoch, epoch < epochs)
        loss = found[LOSS][1][1][0, 0]
        if epoch and loss < best_loss:
            best, best_loss = state, loss
        if epoch < epochs:
            state = state.copy()
            state.move({block: move for block, (_, move) in found.items() if block != LOSS})
    return (best or state).network(share)


def _joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    begins = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=begins[1:])
    return np.concatenate(texts) if texts else np.zeros(0, np.uint64), begins


def _learn(tables, squares, adam, texts: list[np.ndarray], labels: np.ndarray) -> None:
    """One step on a batch of texts."""
    filters, bias, last, shift = adam.weights
    codes, begins = _joined(texts)
    values = _values(tables, filters, codes)
    peaks = np.full((len(texts), len(bias)), -np.inf, np.float32)
    where = np.zeros((len(texts), len(bias)), np.int64)
    for t in range(len(texts)):
        own = values[begins[t] : begins[t + 1]]
        for k, width in enumerate(WIDTHS):
            if len(own) >= width:
                here = slice(k * FILTERS, (k + 1) * FILTERS)
                slid = _slide(own, width)
                at = slid.argmax(axis=0)
                where[t, here] = begins[t] + at
                peaks[t, here] = slid[at, np.arange(FILTERS)]
    maxima = np.maximum(peaks + bias, 0)
    error = (_sigmoid(maxima @ last + shift) - labels) / len(texts)
    back = np.outer(error, last) * (maxima > 0)
    slopes = np.zeros_like(filters)
    seen, pulls = [], []
    for k, width in enumerate(WIDTHS):
        here = slice(k * FILTERS, (k + 1) * FILTERS)
        text, which = np.nonzero(back[:, here])
        strength = back[:, here][text, which].astype(np.float32)[:, None]
        for place in range(width):
            word = codes[where[:, here][text, which] + place]
            column = _STARTS[width] + place * FILTERS + which
            np.add.at(slopes.T, column, strength * _embedded(tables, word))
            seen.append(word)
            pulls.append(strength * filters[:, column].T)
    pull = np.concatenate(pulls)
    for k, rows in enumerate(_unpacked(np.concatenate(seen))):
        _move_rows(tables[k], squares[k], rows, pull[:, k * PART : (k + 1) * PART])
    adam.move([slopes + 1e-4 * filters, back.sum(axis=0).astype(np.float32), maxima.T @ error + 1e-3 * last, np.array([error.sum()])])


def _move_rows(table: np.ndarray, squares: np.ndarray, rows: np.ndarray, pull: np.ndarray) -> None:
    """Steps of the rows that were seen, the smaller the more a row has moved."""
    seen, which = np.unique(rows, return_inverse=True)
    total = np.zeros((len(seen), PART), np.float32)
    np.add.at(total, which, pull)
    squares[seen] += (total * total).mean(axis=1)
    table[seen] -= RATE * total / np.sqrt(squares[seen])[:, None]


def _loss(logits: np.ndarray, labels: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, np.where(labels > 0.5, -logits, logits))))


def _threshold(chances: np.ndarray, labels: np.ndarray, usual: float, copies: np.ndarray | int = 1) -> float:
    """The threshold with the best F1, the one nearest the usual of those that tie; ``copies`` of each chance."""
    copies = np.broadcast_to(copies, len(chances))

    def quality(level: float) -> tuple[float, float]:
        hit = chances >= level
        right = float(copies[hit & (labels > 0.5)].sum())
        return (round(2 * right / max(copies[hit].sum() + (copies * labels).sum(), 1), 9), -abs(level - usual))

    return float(max(LEVELS, key=quality))


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["order", "label", "lang", "piece", "words", "codes"]
    overlap = max(WIDTHS) - 1
    for batch in batches:
        for start, stop in words.slices(batch.column("_text"), TEXT_BYTES):
            part = batch.slice(start, stop - start)
            codes, begins = coded(part.column("_text"))
            owners, pieces, bodies = [], [], []
            for row, (a, b) in enumerate(zip(begins[:-1], begins[1:], strict=True)):
                for piece, at in enumerate(range(a, max(b, a + 1), PIECE_WORDS)):
                    owners.append(row)
                    pieces.append(piece)
                    bodies.append(codes[at : min(at + PIECE_WORDS + overlap, b)])
            kept = [part.column(c).take(pa.array(owners)) for c in ("_order", "_label", "_lang")]
            sizes = pa.array([len(body) for body in bodies], pa.int64())
            numbers = pa.array([body.astype("<u8").tobytes() for body in bodies], pa.binary())
            yield pa.RecordBatch.from_arrays([*kept, pa.array(pieces, pa.int32()), sizes, numbers], names=names)


def _may_be_labelled(chosen: DataFrame):
    """A filter of fixed size on hashes of ids, which lets all labelled ones through."""
    place = F.pmod("_order", F.lit(FILTER_BITS))
    rows = chosen.groupBy(F.floor(place / FILTER_ROW).cast("int").alias("row")).agg(
        F.bitmap_construct_agg(place % FILTER_ROW).alias("bits")
    )
    bits = np.zeros((FILTER_BITS // FILTER_ROW, FILTER_ROW // 8), np.uint8)
    for row in rows.toArrow().to_pylist():
        bits[row["row"]] = np.frombuffer(row["bits"], np.uint8)
    shared = chosen.sparkSession.sparkContext.broadcast(bits.ravel())

    @F.arrow_udf("boolean")
    def found(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            places = part.to_numpy(zero_copy_only=False) % FILTER_BITS
            yield pa.array((shared.value[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1)

    return found


def _learned(source: DataFrame, labelled: DataFrame) -> DataFrame:
    """All rows to learn from, as codes, stored by part: an epoch reads them without a shuffle."""
    chosen = stored(
        labelled.where("_label IS NOT NULL AND _id IS NOT NULL")
        .groupBy("_id")
        .agg(F.min("_label").alias("_label"), F.max("_label").alias("_other"))
        .where("_label = _other")
        .select("_id", "_label", F.xxhash64("_id").alias("_order")),
        "labelled",
    )
    count = chosen.count()
    parts = max(1, -(-count // PART_IDS))
    if count <= BROADCAST_IDS:
        chosen = F.broadcast(chosen)
    else:
        source = source.where(_may_be_labelled(chosen)(F.xxhash64("_id")))
    schema = "order long, label int, lang string, piece int, words long, codes binary"
    rows = source.join(chosen, "_id").select("_order", "_label", "_lang", "_text").mapInArrow(_codes, schema)
    path = f"{work_folder(source.sparkSession)}/parts"
    (
        rows.withColumn("part", F.pmod(F.xxhash64("order"), F.lit(parts)).cast("int"))
        .repartition("part")
        .sortWithinPartitions("part", "order", "piece", "codes", "lang")
        .write.option("compression", "zstd")
        .partitionBy("part")
        .parquet(path)
    )
    return source.sparkSession.read.schema(f"{schema}, part int").parquet(path)


def _held_logits(network: Network):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [np.frombuffer(codes, "<u8") for codes in batch.column("codes").to_pylist()]
            logits = pa.array(network.logits(*_joined(texts)))
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("lang"), logits], names=["label", "lang", "logit"])

    return apply


def _pair_losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Summed losses of every pair of scale and shift."""
    for batch in batches:
        labels, logits = batch.column("label").to_numpy(), batch.column("logit").to_numpy()
        losses = [_loss(a * logits + b, labels) * len(labels) if len(labels) else 0.0 for a, b in PAIRS]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(PAIRS)), pa.int32()), pa.array(losses)], names=["pair", "loss"])


def _levels_passed(scale: float, move: float):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chances = _sigmoid(scale * batch.column("logit").to_numpy() + move)
            passed = pa.array(np.searchsorted(LEVELS, chances, "right"), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("lang"), passed], names=["label", "lang", "passed"])

    return apply


def _adjust(network: Network, held: DataFrame) -> None:
    """Scale, shift and thresholds from the held-back rows (label, lang, codes)."""
    logits = stored(held.mapInArrow(_held_logits(network), "label int, lang string, logit double"), "held")
    losses = logits.select("label", "logit").mapInArrow(_pair_losses, "pair int, loss double")
    best = min(losses.groupBy("pair").agg(F.sum("loss").alias("loss")).collect(), key=lambda r: (r["loss"], r["pair"]))
    network.calibration = PAIRS[best["pair"]]
    passed = logits.mapInArrow(_levels_passed(*network.calibration), "label int, lang string, passed int")
    levels = stored(passed.groupBy("lang", "label", "passed").agg(F.count("*").alias("n")), "levels")
    chances = np.concatenate([[0.0], LEVELS])

    def threshold(rows: list, usual: float) -> float:
        labels, counts = np.array([r["label"] for r in rows]), np.array([r["n"] for r in rows])
        return _threshold(chances[[r["passed"] for r in rows]], labels, usual, counts)

    network.threshold = threshold(levels.groupBy("label", "passed").agg(F.sum("n").alias("n")).collect(), network.threshold)
    enough = levels.where("lang <> ''").groupBy("lang").agg(
        F.sum(F.when(F.col("label") > 0, F.col("n"))).alias("ones"), F.sum(F.when(F.col("label") <= 0, F.col("n"))).alias("zeros")
    )
    named: dict[str, list] = {}
    for row in levels.join(enough.where(F.least("ones", "zeros") >= LEAST_HELD).where("ones > 0 AND zeros > 0"), "lang").collect():
        named.setdefault(row["lang"], []).append(row)
    network.thresholds = {lang: threshold(rows, network.threshold) for lang, rows in sorted(named.items())}


def fit(source: DataFrame, labelled: DataFrame) -> Network:
    """The network for rows (_id, _text, _lang) with labels (_id, _label)."""
    rows = _learned(source, labelled)
    held = F.pmod("order", F.lit(HELD)) == 0
    totals = rows.groupBy(held.alias("held")).agg(
        F.count_if(F.col("piece") == 0).alias("n"),
        F.sum(F.when(F.col("piece") == 0, F.col("label"))).alias("ones"),
        F.min("label").alias("least"),
        F.max("label").alias("most"),
        F.sum("words").alias("words"),
    )
    sides = {r["held"]: r for r in totals.collect()}
    count = sum(r["n"] for r in sides.values())
    share = sum(r["ones"] for r in sides.values()) / count if count else 0.5
    if not sides or min(r["least"] for r in sides.values()) == max(r["most"] for r in sides.values()):
        return Network(share)
    split = len(sides) == 2 and sides[False]["least"] < sides[False]["most"]
    # Bit 1: trained on; bit 2: held back. Very few rows are both.
    roles = F.when(held, 2).otherwise(1) if split else F.lit(3)
    rows = rows.select("part", "codes", "label", "lang", roles.alias("role"))
    network = _best_network(rows.drop("lang"), share, sides[False]["words"] if split else sum(r["words"] for r in sides.values()))
    _adjust(network, rows.where(F.col("role") >= 2).select("label", "lang", "codes"))
    network.tables = [table.astype(np.float16) for table in network.tables]
    return network


def _score_rows(network: Network):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in words.slices(batch.column("_text"), TEXT_BYTES):
                part = batch.slice(start, stop - start)
                scores = pa.array(network.scores(part.column("_text")).astype(np.float64))
                yield pa.RecordBatch.from_arrays([part.column("_id"), part.column("_lang"), scores], names=["id", "lang", "score"])

    return apply


def _threshold_of(network: Network, lang: Column) -> Column:
    found = F.lit(network.threshold)
    for name, level in sorted(network.thresholds.items()):
        found = F.when(lang == name, level).otherwise(found)
    return found


def score(
    df: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    label_column: str = "toxic",
) -> DataFrame:
    """(id, lang, score, threshold, toxic) of every row of ``df``, learned from ``labels`` (id, label).

    The language is no input of the score; it chooses the threshold from which a text is toxic.
    """
    source = df.select(
        F.col(id_column).cast("bigint").alias("_id"),
        F.col(text_column).cast("string").alias("_text"),
        F.col(lang_column).cast("string").alias("_lang"),
    )
    labelled = labels.select(F.col(id_column).cast("bigint").alias("_id"), F.col(label_column).cast("int").alias("_label"))
    network = fit(source, labelled)
    scored = source.mapInArrow(_score_rows(network), "id long, lang string, score double")
    threshold = _threshold_of(network, F.col("lang"))
    return scored.select(
        F.col("id").alias(id_column), F.col("lang").alias(lang_column), "score",
        threshold.alias("threshold"), (F.col("score") >= threshold).alias("toxic"),
    )
