"""Chat formatting with loss masks aligned to token offsets.

A turn becomes ``<s>[INST]role[/INST]text</s>``. A control string inside a role or a text
is escaped by a backslash after its first character, and a backslash by another, so
formatting can be undone exactly. The four control strings are single tokens, so a token
never spans the edge of a text, and a conversation is encoded once as a whole; a very
long one is encoded in blocks of whole turns, which gives the same tokens and bounds the memory
of a task. Token spans are met with the sorted spans of the assistant's texts by
binary search.

A conversation is cut into blocks of ``BLOCK_TURNS`` turn numbers, and the rows of a block meet sorted in one
task and stream through it, so a conversation of any number of turns is formatted by many tasks.
Digests over whole conversations are taken last, over its blocks in order.

Defined results: a null text or role is empty; turns go by number, null first, then role
and text, so ties and repeated rows have one order and are each kept; conversations without an
id form one conversation; a conversation without assistant text has no loss; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BEGIN, OPEN, CLOSE, END = "<s>", "[INST]", "[/INST]", "</s>"
CONTROL = (BEGIN, OPEN, CLOSE, END)
LOSS_ROLE = "assistant"
#: Turn numbers that are formatted together; rows without a number come first.
BLOCK_TURNS = 256
NO_TURN = -(1 << 62)
#: Characters of formatted turns after which a block of a long conversation is encoded.
BLOCK_CHARS = 1 << 20
_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROL))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)

SCHEMA = (
    "conv_id long, block long, part int, n_turns long, text string, input_ids array<int>, "
    "starts array<int>, ends array<int>, loss_mask array<boolean>"
)


def escape(text: str) -> str:
    doubled = text.replace("\\", "\\\\")
    return _CONTROL.sub(lambda found: found[0][0] + "\\" + found[0][1:], doubled)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def read_turns(text: str) -> list[tuple[str, str]]:
    """Roles and texts of formatted turns."""
    return [(unescape(role), unescape(body)) for role, body in _TURN.findall(text)]


_TOKENIZERS: dict = {}


def _tokenizer(path: str):
    """The tokenizer with the control strings as tokens; read once where it is used."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = _with_control_tokens(path)
    return _TOKENIZERS[path]


def _with_control_tokens(path: str):
    from tokenizers import AddedToken, Tokenizer, processors

    tokenizer = Tokenizer.from_file(path)
    tokenizer.add_special_tokens([AddedToken(c, normalized=False, special=True) for c in CONTROL])
    tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)
    return tokenizer


def loss_mask(starts: np.ndarray, ends: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Tokens that lie in one of the sorted spans, by binary search over the span starts."""
    if len(spans) == 0:
        return np.zeros(len(starts), bool)
    at = np.searchsorted(spans[:, 0], starts, "right") - 1
    return (at >= 0) & (ends <= spans[np.maximum(at, 0), 1]) & (ends > starts)


def _render(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray]:
    """Formatted turns and the spans of the texts under the loss."""
    parts, spans, at = [], [], 0
    for role, body in turns:
        head, inner = f"{BEGIN}{OPEN}{escape(role)}{CLOSE}", escape(body)
        if role == LOSS_ROLE and inner:
            spans.append((at + len(head), at + len(head) + len(inner)))
        parts += [head, inner, END]
        at += len(head) + len(inner) + len(END)
    return "".join(parts), np.array(spans, np.int64).reshape(-1, 2)


def _blocks(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conversation, block number, turns) of rows that come sorted by conversation."""
    current, block, turns, size = None, 0, [], 0
    for conversation, role, body in rows:
        if turns and (conversation != current or size >= BLOCK_CHARS):
            yield current, block, turns
            block = block + 1 if conversation == current else 0
            turns, size = [], 0
        current = conversation
        turns.append((role or "", body or ""))
        size += len(body or "")
    if turns:
        yield current, block, turns


def _format(path: str):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                keys = zip(batch.column("conv_id").to_pylist(), batch.column("block").to_pylist(), strict=True)
                yield from zip(keys, *(batch.column(c).to_pylist() for c in ("role", "text")), strict=True)

        held, size = [], 0
        for key, part, turns in _blocks(rows()):
            text, spans = _render(turns)
            held.append(((*key, part), len(turns), text, spans))
            size += len(text)
            if size >= BLOCK_CHARS:
                yield _encoded(tokenizer, held)
                held, size = [], 0
        if held:
            yield _encoded(tokenizer, held)

    return apply


def _encoded(tokenizer, held: list[tuple]) -> pa.RecordBatch:
    encodings = [tokenizer.encode(text, add_special_tokens=False) for _, _, text, _ in held]
    offsets = [np.array(e.offsets, np.int64).reshape(-1, 2) for e in encodings]
    masks = [loss_mask(o[:, 0], o[:, 1], h[3]) for o, h in zip(offsets, held, strict=True)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([h[0][0] for h in held], pa.int64()),
            pa.array([h[0][1] for h in held], pa.int64()),
            pa.array([h[0][2] for h in held], pa.int32()),
            pa.array([h[1] for h in held], pa.int64()),
            pa.array([h[2] for h in held]),
            pa.array([e.ids for e in encodings], pa.list_(pa.int32())),
            pa.array([o[:, 0] for o in offsets], pa.list_(pa.int32())),
            pa.array([o[:, 1] for o in offsets], pa.list_(pa.int32())),
            pa.array([m for m in masks], pa.list_(pa.bool_())),
        ],
        names=["conv_id", "block", "part", "n_turns", "text", "input_ids", "starts", "ends", "loss_mask"],
    )


def format_conversations(df: DataFrame, tokenizer_path: str) -> DataFrame:
    """Formatted text, token ids with offsets and loss mask; one row per conversation, or for each part of a long one.

    ``df`` has conv_id, turn, role and text. A conversation's rows, ordered by (block, part), are its text.
    """
    block = F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(NO_TURN)).cast("bigint")
    rows = df.select("conv_id", block.alias("block"), "turn", "role", "text")
    return (
        rows.repartition("conv_id", "block")
        .sortWithinPartitions("conv_id", "block", "turn", "role", "text")
        .mapInArrow(_format(tokenizer_path), SCHEMA)
    )


def masked_parts(text: str, starts: list[int], ends: list[int], mask: list[bool]) -> list[str]:
    """The runs of text under the mask; tokens that share a character count it once."""
    parts, last = [], -1
    for start, end, loss in zip(starts, ends, mask, strict=True):
        if not loss:
            continue
        if start > last or not parts:
            parts.append(text[start:end])
        elif end > last:
            parts[-1] += text[last:end]
        last = max(last, end)
    return parts


def _read_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is said in each part, and what is under its loss mask."""
    for batch in batches:
        rows = batch.to_pylist()
        turns = [read_turns(row["text"]) for row in rows]
        said = ["".join(f"{role}\n{body}\n" for role, body in some) for some in turns]
        lost = ["".join(map(unescape, masked_parts(r["text"], r["starts"], r["ends"], r["loss_mask"]))) for r in rows]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("conv_id", "block", "part")),
                pa.array([len(some) for some in turns], pa.int64()),
                pa.array(said, pa.string()),
                pa.array(lost, pa.string()),
                pa.array([len(row["text"]) for row in rows], pa.int64()),
            ],
            names=["conv_id", "block", "part", "turns", "said", "lost", "chars"],
        )


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of each conversation over its parts, which come in order."""
    state: dict = {}

    def result() -> tuple:
        return (
            state["conv_id"], state["turns"], state["all"].hexdigest(), state["loss"],
            state["lost"].hexdigest(), state["chars"],
        )

    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if state and row["conv_id"] != state["conv_id"]:
                done.append(result())
                state = {}
            if not state:
                state = {
                    "conv_id": row["conv_id"], "turns": 0, "all": hashlib.sha256(), "loss": 0,
                    "lost": hashlib.sha256(), "chars": 0,
                }
            state["turns"] += row["turns"]
            state["all"].update(row["said"].encode())
            state["loss"] += len(row["lost"])
            state["lost"].update(row["lost"].encode())
            state["chars"] += row["chars"]
        if done:
            yield _digest_batch(done)
    if state:
        yield _digest_batch([result()])


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation: turns, their digest, and the text under the loss mask, from ``format_conversations``."""
    parts = formatted.mapInArrow(
        _read_parts, "conv_id long, block long, part int, turns long, said string, lost string, chars long"
    )
    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "block", "part").mapInArrow(
        _chained,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
