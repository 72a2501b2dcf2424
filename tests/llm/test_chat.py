"""Formatting can be undone, and the mask covers the assistant's texts only."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from ledgerloom.llm import chat

PATH = public_tokenizers.path("byte_bpe_50k.json")
BITS = [
    "\\", "<s>", "</s>", "[INST]", "[/INST]", "<", "s>", "/", "[", "INST]", "\\s", " ", "  ", "\n", "é", "日本", "😀", "ok",
    "<\\s>", "<|endoftext|>", "'s", "​", "é",
]


def random_text(rng):
    return "".join(rng.choice(BITS) for _ in range(rng.randint(0, 9)))


def test_turns_come_back_and_the_mask_is_exact():
    tokenizer = chat._tokenizer(PATH)
    rng = random.Random(3)
    for _ in range(1500):
        turns = [(rng.choice(["user", "assistant", "", "[INST]"]), random_text(rng)) for _ in range(rng.randint(1, 5))]
        text, spans = chat._render(turns)
        assert chat.read_turns(text) == turns
        offsets = np.array(tokenizer.encode(text, add_special_tokens=False).offsets).reshape(-1, 2)
        mask = chat.loss_mask(offsets[:, 0], offsets[:, 1], spans)
        parts = chat.masked_parts(text, offsets[:, 0].tolist(), offsets[:, 1].tolist(), mask.tolist())
        assert "".join(map(chat.unescape, parts)) == "".join(body for role, body in turns if role == "assistant")


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_read_back(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK_CHARS", block)
    rng = random.Random(4)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None]), random_text(rng) or None, "x") for c in range(40) for t in range(rng.randint(1, 9))]
    rows += [(3, 0, "user", "tie", "x"), (3, 0, "user", "tie", "x"), (3, None, "assistant", "first", "x"), (None, 0, "assistant", "no id", "x")]
    rows += [(50, t, "assistant", "long turn " * 30, "x") for t in range(60)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, block string").repartition(3)
    # The block size is used by tasks, so it must be set where they run: call the functions themselves.
    found = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(df, PATH)).collect()}
    assert set(found) == {*range(40), None, 50}
    by_conversation = {}
    for c, t, role, text, _ in rows:
        by_conversation.setdefault(c, []).append((t is not None, t or 0, role is not None, role or "", text is not None, text or ""))
    for c, turns in by_conversation.items():
        ordered = [(x[3], x[5]) for x in sorted(turns)]
        said = "".join(text for role, text in ordered if role == "assistant")
        r = found[c]
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in ordered).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        assert r["formatted_chars"] == len(chat._render(ordered)[0])


def test_long_conversations_are_encoded_in_blocks_with_the_same_tokens(monkeypatch):
    turns = [("user", "a b"), ("assistant", "c </s> d"), ("user", ""), ("assistant", "e")] * 5
    tokenizer = chat._tokenizer(PATH)
    whole = tokenizer.encode(chat._render(turns)[0], add_special_tokens=False).ids
    monkeypatch.setattr(chat, "BLOCK_CHARS", 12)
    blocks = list(chat._blocks((1, role, body) for role, body in turns))
    assert [b for _, b, _ in blocks] == list(range(len(blocks))) and len(blocks) > 3
    parts = [i for _, _, t in blocks for i in tokenizer.encode(chat._render(t)[0], add_special_tokens=False).ids]
    assert parts == whole


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_conversations(df, PATH)).count() == 0


def test_a_long_conversation_is_formatted_by_many_tasks(spark):
    turns = [(7, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(-300, 2500)]
    df = spark.createDataFrame([*turns, (7, None, "assistant", "before"), (8, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(df, PATH)
    rows = formatted.select("conv_id", "block", "part", "n_turns").where("conv_id = 7").collect()
    assert max(r["n_turns"] for r in rows) <= chat.BLOCK_TURNS and len(rows) > 10
    plan = formatted._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(conv_id" in plan and ", block" in plan
    found = {r["conv_id"]: r for r in chat.read_back(formatted).collect()}
    said = "".join(["before", *(f"turn {t}" for _, t, role, _ in turns if role == "assistant")])
    assert found[7]["n_turns"] == len(turns) + 1
    assert found[7]["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
