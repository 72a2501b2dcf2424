"""Word hashes against plain Python splitting."""

from __future__ import annotations

import random
import re
import string

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import words

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def plain(text, lower=True):
    found = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return [word.translate(LOWER) for word in found] if lower else found


def sample_texts():
    rng = random.Random(1)
    pool = ["".join(rng.choice("abcdeéABZ!日😀") for _ in range(rng.randint(1, 6))) for _ in range(400)]
    texts = ["".join(rng.choice(pool) + rng.choice([" ", "  ", "\n", "\t", "\x0b"]) for _ in range(rng.randint(0, 40))) for _ in range(200)]
    return [*texts, None, "", " \n\t", "a", "É é", "x" * 3000 + " tail", "no break line"]


@pytest.mark.parametrize("block", [7, 64, 1 << 19])
def test_words_match_plain_splitting(monkeypatch, block):
    monkeypatch.setattr(words, "BLOCK", block)
    texts = sample_texts()
    hashes, offsets = words.word_hashes(pa.array(texts))
    known = {}
    for row, text in enumerate(texts):
        expected = plain(text)
        found = hashes[offsets[row] : offsets[row + 1]].tolist()
        assert len(found) == len(expected)
        for word, value in zip(expected, found, strict=True):
            assert known.setdefault(word, value) == value
    assert len(set(known.values())) == len(known)
    whole, _ = words.word_hashes(pa.array(texts[::-1])[::1])
    assert set(whole.tolist()) == set(known.values())


def test_slices_cover_all_rows():
    texts = pa.array(["a" * 10, None, "b" * 100, "", "c"])
    cuts = words.slices(texts, 20)
    assert [row for a, b in cuts for row in range(a, b)] == list(range(5))
    assert words.slices(pa.array([], pa.string())) == []
    assert words.slices(texts.slice(2), 1 << 20) == [(0, 3)]


def test_runs_of_short_texts_are_the_whole_text():
    sets = words.distinct_runs(pa.array(["a b c d", "A B", "a b", "b a", "a", "", None, "a b c a b c"]), 3)
    assert [len(s) for s in sets] == [2, 1, 1, 1, 1, 0, 0, 3]
    assert np.array_equal(sets[1], sets[2]) and not np.array_equal(sets[2], sets[3])
