"""The pipeline's stages on a small fixture against brute force."""

from __future__ import annotations

import random

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerloom.llm import jaccard, mixing
from ledgerloom.llm.queries import byte_bpe
from tests.llm.test_jaccard import brute
from tests.llm.test_mixing import brute_targets
from tests.llm.test_pii import base
from tests.llm.test_rules import brute as measure

TYPES = "doc_id long, text string, lang string, source string, n_chars long"


def documents():
    rng = random.Random(8)
    pool = [*"the of and to in is that for it as was with".split(), *(f"word{i}" for i in range(600))]
    rows = []

    def add(text):
        rows.append((len(rows), text, "en", rng.choice(["a", "b", None]), None if text is None else len(text)))

    for _ in range(40):
        found = [rng.choice(pool[: 12 if rng.random() < 0.4 else None]) for _ in range(rng.randint(40, 150))]
        add(" ".join(found))
        if rng.random() < 0.5:
            found[rng.randrange(len(found))] = "changed"
            add(" ".join(found))
        if rng.random() < 0.3:
            add(" ".join(found) + " mail me a.b@example.org or +1 (375) 555-4393 from 10.1.2.3 today")
    for text in (None, "", "too short", "spam " * 60, "*** $$$ " * 20, "line of the day here\n" * 12):
        add(text)
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(documents(), TYPES).write.parquet(f"{path}/documents.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, folder), name)
        assert docs.columns == [c.split()[0] for c in TYPES.split(", ")]
        kept[name] = [tuple(r) for r in docs.collect()]
    clean = kept["quality_rules"]
    for row in documents():
        words, _, symbols, _, repeated = measure(row[1])
        if words < 10 or 100 * repeated > 20 * words or symbols > 0.1 * words:
            assert row not in clean
        elif "\n" not in row[1]:
            assert row in clean
    single = kept["near_duplicates"]
    expected = {i for i, _, c in brute([(r[0], r[1]) for r in clean], 5, jaccard.Threshold(80)) if i == c}
    assert {r[0] for r in single} == expected and len(single) == len(expected) < len(clean)
    redacted = {r[0]: r for r in kept["personal_data"]}
    assert len(redacted) == len(single)
    for row in single:
        after = redacted[row[0]]
        assert after[4] == len(after[1]) and base(after[1]) == ""
        assert (after[1] == row[1]) == (base(row[1]) == "")
    mix = kept["source_mixing"]
    sizes, taken = {}, {}
    for row in redacted.values():
        sizes[row[3]] = sizes.get(row[3], 0) + len(row[1].split())
    for row in mix:
        assert row == redacted[row[0]] and mix.count(row) <= 2
        taken[row[3]] = taken.get(row[3], 0) + len(row[1].split())
    for source, target in brute_targets(sizes, mixing.Recipe()).items():
        assert abs(taken.get(source, 0) - target) <= max(len(r[1].split()) for r in redacted.values())
    name, stage = corpus_pipeline.STAGES[-1]
    pieces = stage(spark, docs, folder).collect()
    tokenizer = Tokenizer.from_file(byte_bpe("json"))
    total = sum(len(tokenizer.encode(row[1], add_special_tokens=False).ids) + 1 for row in mix)
    assert sum(p["length"] for p in pieces) == total
    ends = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert ends.get(p["sequence_id"], 0) == p["offset"]
        ends[p["sequence_id"]] = p["offset"] + p["length"]
    assert max(ends.values()) <= 2048 and len(ends) <= -(-total // 2048) + 1


def test_run_gives_the_same_rows_again(spark, folder):
    def rows():
        return sorted(tuple(r) for r in corpus_pipeline.run(spark, folder).collect())

    first = rows()
    assert first and [r[:5] for r in first] == [r[:5] for r in rows()]


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], TYPES).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_nulls_repeated_ids_long_texts_and_columns_of_any_name(spark, tmp_path):
    names = ["_drop", "seq", "t1", "_source", "sure", "loose", "kept", "size", "taken", "copies", "_row", "n_words", "_id", "length"]
    rng = random.Random(9)
    some = [row for row in documents() if row[1] and len(row[1]) > 100]
    long = " ".join(["the", *(f"w{rng.randrange(10**6)}" for _ in range(60_000))] * 1)
    rows = [*some, (None, some[0][1] + " the end of it", None, None, None), (some[1][0], some[5][1] + " and more of that", "en", None, 5)]
    rows += [some[2], some[2], (None, None, None, None, None), (7000, "the " + long, "sv", "c", None)]
    schema = TYPES + ", " + ", ".join(f"{n} string" for n in names)
    docs = spark.createDataFrame([(*row, *names) for row in rows], schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == [c.split()[0] for c in schema.split(", ")]
        assert all([r[n] for n in names] == names for r in docs.select(*names).collect())
    assert docs.where("doc_id = 7000").count() > 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    copies = docs.where("doc_id = 7000").count()
    own = [p for p in pieces if p["doc_id"] == 7000]
    assert max(p["length"] for p in pieces) <= 2048 and len(own) > 30 * copies
