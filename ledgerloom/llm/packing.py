"""Packing of token pieces into sequences by best two-fit.

A sequence takes the longest piece left and, greedily, the longest one that still fits,
until none does. Then its smallest piece is taken out again if two unpacked pieces fill
the gap that leaves more tightly, as long as that helps.

What a sequence holds depends on how many pieces of each length are left and on nothing
else, so the plan is made on the counts by length, of which there are at most as many as
a sequence has tokens: a filling is repeated as long as its lengths last. The plan maps
the pieces, numbered by length over the cluster, to sequences and offsets. All pieces of
the table are packed together, whatever their number, and no piece passes the driver.

Defined results: a null text is empty, that is one end token; a null or repeated id is kept
as it is; equal pieces are interchangeable; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.groups import numbered
from ledgerloom.session import work_folder

CAPACITY = 2048
END_ID = 0
BATCH_BYTES = 1 << 22


_ENCODERS: dict = {}


def _encoder(rank_path: str, added: dict[str, int] | None = None):
    """Byte-level BPE from a file of ranks, read once where it is used; the ids are those of the same vocabulary."""
    added = added or {}
    key = (rank_path, *sorted(added.items()))
    if key not in _ENCODERS:
        _ENCODERS[key] = _read_encoder(rank_path, added)
    return _ENCODERS[key]


def _read_encoder(rank_path: str, added: dict[str, int]):
    import base64

    import public_tokenizers
    import tiktoken

    with open(rank_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added
    )


def _ids(encoder, text: str, added: dict[str, int] | None = None) -> bytes:
    """Little-endian unsigned 32-bit ids of a text; the strings of added tokens are those tokens."""
    try:
        coded = encoder.encode_to_numpy(text, allowed_special="all") if added else encoder.encode_to_numpy(text)
        return coded.astype("<u4").tobytes()
    except ValueError:
        # The fast splitter gives up on white space of some hundred thousand characters.
        import public_tokenizers
        import regex

        # Every other piece is an added token.
        pieces = regex.split(f"({'|'.join(map(regex.escape, sorted(added)))})", text) if added else [text]
        parts = (
            [added[piece]] if place % 2 else encoder._encode_single_piece(p)
            for place, piece in enumerate(pieces)
            for p in ([piece] if place % 2 else regex.findall(public_tokenizers.PATTERN, piece))
        )
        return b"".join(np.array(part, "<u4").tobytes() for part in parts)


def _pieces(rank_path: str, capacity: int, added: dict[str, int] | None):
    end = np.array([END_ID], "<u4").tobytes()

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
        names = ["doc_id", "piece", "start", "length", "ids"]
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(rank_path, added)

        def made(ids: list, texts: list[str]) -> list[tuple]:
            rows = []
            for doc_id, text in zip(ids, texts, strict=True):
                coded = _ids(encoder, text, added) + end
                total = len(coded) // 4
                first = total if total <= capacity else (total % capacity or capacity)
                edges = [0, *range(first, total + 1, capacity)]
                for piece, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                    rows.append((doc_id, piece, a, b - a, coded[4 * a : 4 * b]))
            return rows

        for batch in batches:
            ids, texts, size = [], [], 0
            for doc_id, text in zip(batch.column("_id").to_pylist(), batch.column("_text"), strict=True):
                ids.append(doc_id)
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= BATCH_BYTES:
                    yield batch_of(made(ids, texts))
                    ids, texts, size = [], [], 0
            if ids:
                yield batch_of(made(ids, texts))

    return apply


def tokenize(
    df: DataFrame,
    rank_path: str,
    capacity: int = CAPACITY,
    id_column: str = "doc_id",
    text_column: str = "text",
    added: dict[str, int] | None = None,
) -> DataFrame:
    """(doc_id, piece, start, length, ids) of every text; only longer texts are cut, the first piece short.

    ``added`` are the tokenizer's added tokens, whose strings in a text become their ids.
    """
    source = df.select(F.col(id_column).cast("bigint").alias("_id"), F.col(text_column).alias("_text"))
    return source.mapInArrow(
        _pieces(rank_path, capacity, added), "doc_id long, piece int, start long, length long, ids binary"
    )


def fillings(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """What to put into sequences: lists of lengths, and how many sequences each list fills."""
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    lengths = np.arange(capacity + 1)
    plan = []
    while left.any():
        bin_lengths: list[int] = []
        free = left.copy()
        gap = capacity
        while True:
            fit = np.flatnonzero(free[: gap + 1])
            if len(fit) == 0:
                break
            # Whole copies at once: texts of a few tokens else fill a sequence one by one.
            longest = int(fit[-1])
            times = min(gap // longest, int(free[longest]))
            bin_lengths += [longest] * times
            free[longest] -= times
            gap -= longest * times
        while gap and bin_lengths:
            smallest = bin_lengths[-1]
            room = gap + smallest
            below = np.maximum.accumulate(np.where(free > 0, lengths, 0))
            twice = np.maximum.accumulate(np.where(free > 1, lengths, 0))
            first = np.flatnonzero(free[:room])
            if len(first) == 0:
                break
            second = below[room - first]
            # A length may pair with itself only if two of it are left.
            same = second == first
            if same.any():
                lower = below[np.maximum(first - 1, 0)]
                second = np.where(same, np.where(twice[first] == first, second, lower), second)
            both = np.where(second > 0, first + second, 0)
            best = int(both.argmax())
            if both[best] <= smallest:
                break
            free[smallest] += 1
            bin_lengths.pop()
            for taken in (int(first[best]), int(second[best])):
                free[taken] -= 1
                bin_lengths.append(taken)
            bin_lengths.sort(reverse=True)
            gap = room - int(both[best])
        used = Counter(bin_lengths)
        times = min(int(left[length]) // count for length, count in used.items())
        for length, count in used.items():
            left[length] -= times * count
        plan.append((bin_lengths, times))
    return plan


def _slots(counts: dict[int, int], plan: list[tuple[list[int], int]]) -> np.ndarray:
    """Rows (first piece number, first sequence, offset): pieces from there on go to consecutive sequences."""
    following, total = {}, 0
    for length in sorted(counts):
        following[length] = total
        total += counts[length]
    slots, sequence = [], 0
    for lengths, times in plan:
        offset = 0
        for length in lengths:
            slots.append((following[length], sequence, offset))
            following[length] += times
            offset += length
        sequence += times
    return np.array(sorted(slots), np.int64).reshape(-1, 3)


def _placed(slots: np.ndarray):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column("_number").to_numpy()
            at = np.searchsorted(slots[:, 0], number, "right") - 1
            names = [n for n in batch.schema.names if n != "_number"]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(n) for n in names],
                    pa.array(slots[at, 1] + number - slots[at, 0]),
                    pa.array(slots[at, 2]),
                ],
                names=[*names, "sequence_id", "offset"],
            )

    return apply


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces (doc_id, piece, length and any others)."""
    spark = pieces.sparkSession
    counts = {row["length"]: row["count"] for row in pieces.groupBy("length").count().collect()}
    tied = pieces.withColumn("_tie", F.monotonically_increasing_id())
    rows = numbered(tied, [], ["length", "doc_id", "piece", "_tie"], f"{work_folder(spark)}/pieces")
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return (
        rows.withColumn("_number", F.col("seq") - 1)
        .select(*pieces.columns, "_number")
        .mapInArrow(_placed(_slots(counts, fillings(counts, capacity))), f"{names}, sequence_id long, offset long")
    )
