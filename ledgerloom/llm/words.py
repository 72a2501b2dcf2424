"""Word hashes of whole text columns, computed on Arrow buffers.

A word is a run of bytes other than ASCII white space; A to Z count as lower case
when asked. Its 64-bit hash is a polynomial over the bytes, taken from running sums,
so no Python object is made per word. Different words share a hash with a chance of
about 2 ** -64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLOCK = 1 << 19
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_SPACES = (9, 10, 11, 12, 13, 32)


def mix(values: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit hash of 64-bit values."""
    z = values.astype(np.uint64, copy=True)
    z += np.uint64(0x9E3779B97F4A7C15)
    z ^= z >> np.uint64(30)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z


def _byte_values(lower: bool) -> np.ndarray:
    values = mix(np.arange(256, dtype=np.uint64))
    if lower:
        values[65:91] = values[97:123]
    return values


_VALUES = {lower: _byte_values(lower) for lower in (True, False)}
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(_SPACES)] = True
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; made once where they are used."""
    if size not in _TABLES:
        _TABLES[size] = tuple(
            np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size - 1, base, np.uint64)]))
            for base in (_BASE, pow(_BASE, -1, 1 << 64))
        )
    return _TABLES[size]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and where each text begins (with the end as last entry)."""
    column = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data, offsets


def word_hashes(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and where each text's words begin (and end)."""
    if len(texts) == 0:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    data, offsets = text_bytes(texts)
    edges = np.unique(offsets)
    hashes, begins = [], []
    carried, carried_length, carried_begin = 0, 0, 0
    position, end = int(offsets[0]), int(offsets[-1])
    powers, inverse = _powers(BLOCK)
    while position < end:
        block = data[position : min(position + BLOCK, end)]
        size = len(block)
        inner = edges[np.searchsorted(edges, position) : np.searchsorted(edges, position + size, "right")] - position
        space = _IS_SPACE[block]
        before = np.empty(size, dtype=bool)
        before[0], before[1:] = True, space[:-1]
        before[inner[inner < size]] = True
        first = np.flatnonzero(before & ~space)
        after = np.empty(size, dtype=bool)
        after[-1], after[:-1] = True, space[1:]
        after[inner[inner > 0] - 1] = True
        last = np.flatnonzero(after & ~space)
        sums = np.cumsum(_VALUES[lower][block] * powers[:size], dtype=np.uint64)
        below = np.where(first > 0, sums[np.maximum(first, 1) - 1], np.uint64(0))
        values = (sums[last] - below) * inverse[first]
        begin = first + position
        lengths = last - first + 1
        if carried_length:
            if len(first) and first[0] == 0 and position not in (int(e) for e in inner + position if e == 0):
                joined = (carried + pow(_BASE, carried_length, 1 << 64) * int(values[0])) & _MASK
                values[0] = joined
                begin[0] = carried_begin
                lengths[0] += carried_length
            else:
                hashes.append(np.array([carried], dtype=np.uint64) + np.uint64(carried_length & _MASK))
                begins.append(np.array([carried_begin]))
            carried_length = 0
        open_end = size and position + size < end and not space[-1] and position + size not in inner + position
        if open_end and len(last):
            carried, carried_length, carried_begin = int(values[-1]), int(lengths[-1]), int(begin[-1])
            values, begin, lengths = values[:-1], begin[:-1], lengths[:-1]
        hashes.append(values + lengths.astype(np.uint64))
        begins.append(begin)
        position += size
    if carried_length:
        hashes.append(np.array([carried], dtype=np.uint64) + np.uint64(carried_length & _MASK))
        begins.append(np.array([carried_begin]))
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    return mix(np.concatenate(hashes)), np.searchsorted(np.concatenate(begins), offsets)


def slices(texts: pa.Array, most_bytes: int = 4 << 20) -> list[tuple[int, int]]:
    """Consecutive row ranges of at most that many bytes, or of one longer text."""
    if len(texts) == 0:
        return []
    _, offsets = text_bytes(texts)
    cuts, start = [], 0
    while start < len(texts):
        stop = int(np.searchsorted(offsets, offsets[start] + most_bytes, "right")) - 1
        stop = min(max(stop, start + 1), len(texts))
        cuts.append((start, stop))
        start = stop
    return cuts


def runs(hashes: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``length`` words, and where each text's runs begin.

    A text with fewer words, but some, has one run: all of its words.
    """
    counts = np.diff(offsets)
    amounts = np.where(counts >= length, counts - length + 1, np.minimum(counts, 1))
    starts = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(amounts, out=starts[1:])
    factors = mix(np.arange(1, length + 1, dtype=np.uint64)) | np.uint64(1)
    padded = np.concatenate([hashes, np.zeros(length, np.uint64)])
    total = np.zeros(len(hashes), np.uint64)
    for k in range(length):
        total += padded[k : k + len(hashes)] * factors[k]
    within = np.arange(starts[-1]) - np.repeat(starts[:-1], amounts)
    at = np.repeat(offsets[:-1], amounts) + within
    found = total[at]
    for text in np.flatnonzero((counts > 0) & (counts < length)):
        words = hashes[offsets[text] : offsets[text + 1]]
        found[starts[text]] = np.add.reduce(words * factors[: len(words)]) + np.uint64(len(words))
    return mix(found), starts


def distinct_runs(texts: pa.Array, length: int, lower: bool = True) -> list[np.ndarray]:
    """The sorted set of word-run hashes of each text."""
    hashes, offsets = word_hashes(texts, lower)
    found, starts = runs(hashes, offsets, length)
    return [np.unique(found[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)]
