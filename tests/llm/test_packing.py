"""Pieces, tokens and places of the packing."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from ledgerloom.llm import packing
from ledgerloom.llm.store import stored

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def tokens(text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def test_fillings_use_every_piece_once_and_come_near_the_bound():
    rng = random.Random(1)
    for _ in range(30):
        counts = Counter(min(64, int(rng.paretovariate(0.8))) for _ in range(rng.randint(0, 400)))
        plan = packing.fillings(counts, 64)
        used = Counter()
        for lengths, times in plan:
            assert sum(lengths) <= 64 and times > 0
            for length in lengths:
                used[length] += times
        assert used == counts
        bound = -(-sum(k * n for k, n in counts.items()) // 64)
        assert sum(t for _, t in plan) <= bound + max(2, bound // 10)


def test_two_smaller_pieces_replace_the_smallest():
    # Greedy fills 6 + 3 and leaves a gap of 1; 2 + 2 fill it better than the 3.
    plan = packing.fillings({6: 1, 3: 1, 2: 2}, 10)
    assert sorted(plan[0][0]) == [2, 2, 6]


def test_places_and_tokens(spark):
    rng = random.Random(3)
    pool = ["the", "é", "日本", "don't", "x1", "  ", "\n", "<|endoftext|>", "😀"]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.choice([0, 3, 20, 90]))) for _ in range(80)]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(80, None, 1), (81, "", 1), (3, texts[3], 1), (None, "a b", 1), (82, "w " * 700, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int")
    pieces = stored(packing.tokenize(df, RANKS, 64), "pieces")
    placed = packing.place(pieces, 64).collect()
    sequences, by_doc = {}, {}
    for r in placed:
        assert len(r["ids"]) == 4 * r["length"] <= 256
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append(r)
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 64
    for doc_id, text, _ in rows:
        ids = tokens(text)
        times = 2 if doc_id == 3 else 1
        own = sorted(by_doc[doc_id], key=lambda r: r["piece"])
        assert sum(r["length"] for r in own) == times * len(ids)
        for r in own:
            assert np.frombuffer(r["ids"], "<u4").tolist() == ids[r["start"] : r["start"] + r["length"]]
            assert r["length"] == 64 or r["piece"] == 0
    total = sum(r["length"] for r in placed)
    assert len(sequences) <= -(-total // 64) + 2


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.place(stored(packing.tokenize(df, RANKS), "none")).count() == 0


def test_long_white_space_has_the_same_ids():
    encoder = packing._encoder(RANKS)

    class Refusing:
        _encode_single_piece = encoder._encode_single_piece

        def encode_to_numpy(self, text):
            raise ValueError

    for text in ("a  b\n \n c", "\n" * 5 + " " * 30 + "b", " " * 40):
        assert packing._ids(Refusing(), text) == packing._ids(encoder, text)
    assert len(packing._ids(encoder, " " * 1_000_000 + "a")) > 0


def test_added_tokens_are_those_of_the_default_call(spark):
    from ledgerloom.llm.queries import added_tokens

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|> <|endof", "plain", "<|endoftext|>" + " " * 400_000 + "<|endoftext|>"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pieces = packing.tokenize(df, RANKS, 1 << 20, added=added_tokens()).collect()
    found = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in pieces}
    for doc_id, text in enumerate(texts):
        assert found[doc_id] == tokenizer.encode(text, add_special_tokens=False).ids + [0]
    assert found[0] == [64, 220, 50256, 275, 0]
