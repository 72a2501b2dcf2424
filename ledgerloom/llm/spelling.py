"""Spelling variants of a vocabulary by permuterm rotations.

A word is marked with a terminator and rotated. Words that differ in one code point have
rotations that end in it and agree before it; a word with one code point more has a rotation that
agrees, before its last code point, with a whole rotation of the shorter word. So every
rotation goes to the range of its prefix without the last code point, and, whole, to its own;
rows are dealt and sorted by that prefix, and a scan of each range gives every member the
number of its neighbours there and the most frequent of them. Pairs are not formed.

A range holds at most one whole word and one word for each last code point, so its size is
bounded by the alphabet and no range is hot. Equal neighbouring code points give one indel in
several ranges: only the last of such a run counts.

Prefixes of more than ``LONG`` code points are replaced by 124-bit running hashes, so a word of any
length costs as many rows of fixed size as it has code points; its text is joined to a row only
where it has a neighbour.

Defined results: null words are left out; a repeated word counts with the sum of its numbers;
a null number is 0; a word without neighbours has no form and is its own root; ties of forms
go to the least word in code-point order; an empty table gives no rows; other columns are not
read, and a terminator inside a word is refused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.store import stored

END = "$"
LONG = 64
RATIO = 10
LEAST_LENGTH = 7
LEAST_COUNT = 2
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PRIMES = (2_147_483_647, 2_147_483_629, 2_147_483_587, 2_147_483_579)
_BASES = (1_000_003, 1_299_709, 15_485_863, 32_452_843)
_CHUNK = 1 << 16


def counted_words(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    misspelt: int = 31,
) -> DataFrame:
    """(word, n) of all texts: lower-cased runs of letters, some of them with a code point deleted.

    A run loses a code point where ``misspelt`` divides the checksum of its document's id and itself;
    0 leaves all runs as they are. A null text has no words; a null id counts as an empty one.
    """
    # Shorter runs cannot become long enough, so they are not taken out of the text at all.
    pattern = f"[a-zÀ-ÿ]{{{least_length},}}"
    name = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    runs = df.select(
        name.alias("id"),
        F.explode(F.regexp_extract_all(F.translate(text_column, _UPPER, _LOWER), F.lit(pattern), F.lit(0))).alias("run"),
    )
    word = F.col("run")
    if misspelt:
        check = F.crc32(F.concat("id", F.lit(":"), "run"))
        at = (check % F.char_length("run")).cast("int")
        cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
        word = F.when(check % misspelt == 0, cut).otherwise(word)
    return (
        runs.select(word.alias("word"))
        .where(F.char_length("word") >= least_length)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= least_count)
    )


def _short_rows(words: DataFrame, long: int) -> DataFrame:
    """Rotations (key, last, n, word) whose key has at most ``long`` code points; a whole one has no last."""
    size = F.char_length("word")
    both = F.concat("word", F.lit(END), "word")
    skipping = F.transform(
        F.sequence(F.lit(1), size),
        lambda i: F.struct(F.substring(both, i + 1, size).alias("key"), F.substring(F.col("word"), i, F.lit(1)).alias("last")),
    )
    whole = F.transform(
        F.sequence(F.lit(1), size + 1),
        lambda i: F.struct(F.substring(both, i, size + 1).alias("key"), F.lit("").alias("last")),
    )
    none = F.array().cast("array<struct<key:string,last:string>>")
    every = F.concat(
        F.when(size <= long, skipping).otherwise(none), F.when(size < long, whole).otherwise(none)
    )
    rows = words.where(size <= long).select("n", F.explode(every).alias("r")).select("r.key", "r.last", "n")
    # The word is in its key: what stands after the terminator, the last code point, what stands before.
    word = F.concat(F.substring_index("key", END, -1), F.col("last"), F.substring_index("key", END, 1))
    one_run = F.col("last") == F.substring("key", 1, 1)
    return rows.repartition("key").select("key", "last", (~one_run).alias("counts"), "n", word.alias("word"))


def _powers(base: int, prime: int, size: int) -> np.ndarray:
    powers = np.ones(1, np.uint64)
    while len(powers) < size:
        powers = np.concatenate([powers, powers * np.uint64(pow(base, len(powers), prime)) % np.uint64(prime)])
    return powers[:size]


def _rotation_hashes(word: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the rotations without their last code point, by what they skip, and of all whole rotations."""
    size = len(word)
    codes = np.array([ord(c) + 1 for c in word + END + word], np.uint64)
    found = []
    for base, prime in zip(_BASES, _PRIMES, strict=True):
        p = np.uint64(prime)
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * _powers(base, prime, len(codes)) % p, out=sums[1:])
        sums %= p
        back = _powers(pow(base, -1, prime), prime, size + 1)

        def window(first: np.ndarray, length: int, sums=sums, back=back, p=p) -> np.ndarray:
            return (sums[first + length] + p - sums[first]) % p * back[first] % p

        found.append((window(np.arange(1, size + 1), size), window(np.arange(size + 1), size + 1)))
    return tuple(
        np.stack([(a[k] << np.uint64(31)) | b[k] for a, b in (found[:2], found[2:])], axis=1).astype("<i8") for k in (0, 1)
    )


def _long_keys(long: int):
    names = ["high", "low", "last", "counts", "id"]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for word, name in zip(batch.column("word").to_pylist(), batch.column("id").to_pylist(), strict=True):
                skipping, whole = _rotation_hashes(word)
                for keys, skips in ((skipping, True), (whole, False)):
                    if len(word) + (not skips) <= long:
                        continue
                    for start in range(0, len(keys), _CHUNK):
                        part = keys[start : start + _CHUNK]
                        last = list(word[start : start + _CHUNK]) if skips else [""] * len(part)
                        after = word[start + 1 : start + 1 + _CHUNK].ljust(len(part), END) if skips else last
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(part[:, 0].copy()),
                                pa.array(part[:, 1].copy()),
                                pa.array(last, pa.string()),
                                pa.array([a != b for a, b in zip(last, after, strict=True)], pa.bool_()),
                                pa.array([name] * len(part), pa.string()),
                            ],
                            names=names,
                        )

    return apply


def _long_rows(words: DataFrame, long: int) -> DataFrame:
    """Rotations whose key is longer, of words with a neighbour in the key's range, by the hash of the key."""
    some = words.where(F.char_length("word") >= long).withColumn("id", F.sha2("word", 256))
    keys = some.select("word", "id").mapInArrow(
        _long_keys(long), "high long, low long, last string, counts boolean, id string"
    )
    place = Window.partitionBy("high", "low")
    skips = F.sum((F.col("last") != "").cast("int")).over(place)
    indels = F.sum(F.col("counts").cast("int")).over(place)
    wholes = F.sum((F.col("last") == "").cast("int")).over(place)
    near = F.when(F.col("last") == "", F.col("indels") > 0).otherwise(
        (F.col("skips") > 1) | (F.col("counts") & (F.col("wholes") > 0))
    )
    met = keys.select("*", skips.alias("skips"), indels.alias("indels"), wholes.alias("wholes")).where(near)
    key = F.concat_ws(END, F.lit(""), F.lit(""), F.col("high").cast("string"), F.col("low").cast("string"))
    return met.join(some, "id").select(key.alias("key"), "last", "counts", "n", "word")


def _near(rows: DataFrame) -> DataFrame:
    """(word, n_near, near_n, near) of all words with a neighbour: how many, and the most frequent."""
    ranked = Window.partitionBy("key").orderBy("less", "word")
    whole_range = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    skips = F.col("last") != ""

    def total(condition: Column) -> Column:
        return F.sum(condition.cast("int")).over(whole_range)

    scanned = rows.withColumn("less", -F.col("n")).select(
        "word",
        "last",
        "counts",
        total(skips).alias("skips"),
        total(skips & F.col("counts")).alias("indels"),
        total(~skips).alias("wholes"),
        F.row_number().over(ranked).alias("place"),
        F.first(F.struct("less", "word")).over(whole_range).alias("first"),
        F.lead(F.struct("less", "word")).over(ranked).alias("second"),
    )
    # Indels that count in another range are near words here too, so only the number looks at that.
    partners = F.when(F.col("last") == "", F.col("indels")).otherwise(
        F.col("skips") - 1 + F.when(F.col("counts"), F.col("wholes")).otherwise(0)
    )
    best = F.when(F.col("place") == 1, F.col("second")).otherwise(F.col("first"))
    return (
        scanned.select("word", partners.cast("bigint").alias("partners"), best.alias("best"))
        .where("best IS NOT NULL")
        .groupBy("word")
        .agg(F.sum("partners").alias("n_near"), F.min("best").alias("best"))
        .select("word", "n_near", (-F.col("best.less")).alias("near_n"), F.col("best.word").alias("near"))
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form (word, form): each round doubles the steps taken."""
    current = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(current.join(onward, "root", "left"), "roots")
        if moved.where("next IS NOT NULL").isEmpty():
            return current
        current = moved.select("word", F.coalesce("next", "root").alias("root"))


def variants(words: DataFrame, ratio: int = RATIO, long: int = LONG) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of a vocabulary (word, n).

    Near words differ by one inserted, deleted or replaced code point. A form is the most frequent
    near word, if it occurs ``ratio`` times as often; a root is where forms lead to.
    """
    marked = F.when(F.contains("word", F.lit(END)), F.raise_error("a word holds the terminator"))
    vocabulary = stored(
        words.where("word IS NOT NULL AND word <> ''")
        .groupBy(F.coalesce(marked, "word").alias("word"))
        .agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n")),
        "vocabulary",
    )
    near = _near(_short_rows(vocabulary, long).unionByName(_long_rows(vocabulary, long)))
    often = F.col("near_n") >= ratio * F.col("n")
    formed = stored(
        vocabulary.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(often, F.col("near")).alias("form"),
            F.when(often, F.col("near_n")).alias("form_n"),
        ),
        "formed",
    )
    roots = _roots(formed.where("form IS NOT NULL"))
    return formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
