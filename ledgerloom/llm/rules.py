"""Quality rules: a table of thresholds compiled into one projection.

Everything is built-in Spark functions over one row, so filtering a corpus is a
scan without shuffle and without Python.

Defined results: a null or empty text has no words and fails ``min_words``;
repeated rows are judged alike, each on its own; an empty table stays empty;
columns of the input are kept, and ones named like an added column are replaced.

The stop-word rule needs to know the language. With a language column it holds for texts
whose language is one of ``STOP_WORDS``, in upper or lower case; texts of other or unknown
languages have no ratio and pass it. Without one, as in the query's SQL check, it holds for
every text and counts words as they are written, so other languages are rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.once import bind, with_once

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 5

# Common short words of the languages the rules know.
STOP_WORDS = {
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch".split(),
    "en": "the of and to in a is that for it as was with be by on not he his are this at from".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se".split(),
}


@dataclass(frozen=True)
class Rule:
    """A measured value must lie in [low, high]; None is no bound."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: Verdict of the contract's base rules.
BASE = (
    Rule("min_words", "n_words", low=10),
    Rule("repeated_words", "repeat_percent", high=20),
)

#: Further rules on ratios. The stop-word ratio counts one more than there are, so a text
#: of a few words is not rejected for having none.
RATIOS = (
    Rule("word_length", "mean_word_length", low=1.5, high=15),
    Rule("symbols", "symbols_per_word", high=0.1),
    Rule("stop_words", "stop_word_ratio", low=0.02),
    Rule("repeated_lines", "dup_line_ratio", high=0.4),
)


#: Columns that ``judge`` adds.
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_repeat_words", "n_dup_lines", "repeat_percent", "mean_word_length",
    "symbols_per_word", "stop_word_ratio", "dup_line_ratio",
)
ADDED = (*MEASURES, "base_failed", "broken_rules", "kept")


def words_of(text: Column) -> Column:
    """Words between ASCII white space."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def _windows(words: Column, value) -> Column:
    """``value(i)`` for each window of five words, which starts at word i."""
    last = F.size(words) - WINDOW
    return F.when(last < 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), last), value)
    )


def _repeated_exactly(words: Column) -> Column:
    """Words inside windows whose five words occur at least twice in the text."""

    def window(start: Column) -> Column:
        return F.struct(F.array_join(F.slice(words, start + 1, WINDOW), " ").alias("w"), start.alias("i"))

    def covered(starts: Column) -> Column:
        last = F.size(starts) - 1

        def add(total: Column, k: Column) -> Column:
            step = F.when(k == last, WINDOW).otherwise(
                F.least(F.lit(WINDOW), F.get(starts, k + 1) - F.get(starts, k))
            )
            return total + step

        return F.when(last < 0, F.lit(0).cast("bigint")).otherwise(
            F.aggregate(F.sequence(F.lit(0), last), F.lit(0).cast("bigint"), add)
        )

    def equal_neighbours(ordered: Column) -> Column:
        def same(k: Column, other: Column) -> Column:
            return F.coalesce(F.get(ordered, k)["w"] == F.get(ordered, other)["w"], F.lit(False))

        found = F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1), lambda k: same(k, k - 1) | same(k, k + 1)
        )
        starts = F.sort_array(F.transform(found, lambda k: F.get(ordered, k)["i"]))
        return bind(starts, covered)

    return bind(
        F.sort_array(F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), window)), equal_neighbours
    )


def _repeat_words(words: Column) -> Column:
    """As ``_repeated_exactly``; texts without two equal window hashes skip the exact pass."""
    hashes = _windows(words, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))
    twice = bind(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(twice, _repeated_exactly(words)).otherwise(F.lit(0).cast("bigint"))


def _known_language(lang: Column) -> Column:
    """Whether a language tag (en, EN, en-US, en_GB) is of a language with stop words."""
    return F.coalesce(F.lower(F.regexp_extract(lang, "^[A-Za-z]+(?![A-Za-z])", 0)).isin(list(STOP_WORDS)), F.lit(False))


def measured(df: DataFrame, text: str = "text", lang: str | None = None) -> DataFrame:
    """Add what the rules are about, for the whole text of every row; ``lang`` names a column of language tags."""
    body = F.coalesce(F.col(text), F.lit(""))
    stop = sorted({word for words in STOP_WORDS.values() for word in words})
    split = with_once(df, _words=words_of(body))
    lines = F.filter(F.split(body, "\n"), lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]")))
    words = F.col("_words")
    counted = with_once(
        split,
        n_words=F.size(words).cast("bigint"),
        word_chars=F.aggregate(
            words, F.lit(0).cast("bigint"), lambda total, word: total + F.char_length(word)
        ),
        n_symbols=F.char_length(F.regexp_replace(body, r"[^#*$%&|<>]+", "")).cast("bigint"),
        _lines=F.struct(F.size(lines).alias("all"), F.size(F.array_distinct(lines)).alias("distinct")),
        n_repeat_words=_repeat_words(words),
        _stops=F.size(F.filter(words, lambda word: (F.lower(word) if lang else word).isin(stop))),
    )
    some = F.greatest(F.col("n_words"), F.lit(1))
    stop_ratio = (F.col("_stops") + 1) / some
    return (
        counted.withColumn("n_dup_lines", (F.col("_lines.all") - F.col("_lines.distinct")).cast("bigint"))
        .withColumn("repeat_percent", 100 * F.col("n_repeat_words") / some)
        .withColumn("mean_word_length", F.col("word_chars") / some)
        .withColumn("symbols_per_word", F.col("n_symbols") / some)
        .withColumn("stop_word_ratio", F.when(_known_language(F.col(lang)), stop_ratio) if lang else stop_ratio)
        .withColumn("dup_line_ratio", F.col("n_dup_lines") / F.greatest(F.col("_lines.all"), F.lit(1)))
        .drop("_words", "_lines", "_stops")
    )


def broken(rules: tuple[Rule, ...]) -> Column:
    """Names of the rules a measured row breaks; a null measure breaks none."""
    checks = []
    for rule in rules:
        value, wrong = F.col(rule.measure), F.lit(False)
        if rule.low is not None:
            wrong = wrong | (value < rule.low)
        if rule.high is not None:
            wrong = wrong | (value > rule.high)
        checks.append(F.when(wrong, F.lit(rule.name)))
    return F.array_compact(F.array(*checks))


def judge(
    df: DataFrame,
    text: str = "text",
    base: tuple[Rule, ...] = BASE,
    ratios: tuple[Rule, ...] = RATIOS,
    lang: str | None = None,
) -> DataFrame:
    """Add the measures, ``base_failed``, the names of broken rules and ``kept``.

    Other columns are kept, whatever their names; ones named like an added column are replaced.
    """
    # Each row as a whole, so that none of its columns is taken for one of these.
    tags = [F.col(lang).cast("string").alias("_lang")] if lang else []
    whole = df.select(
        F.struct(*[F.col(f"`{name}`") for name in df.columns if name not in ADDED]).alias("_row"),
        F.col(text).alias("_text"),
        *tags,
    )
    return (
        measured(whole, "_text", "_lang" if lang else None)
        .withColumn("base_failed", F.size(broken(base)) > 0)
        .withColumn("broken_rules", broken(base + ratios))
        .withColumn("kept", F.size("broken_rules") == 0)
        .select("_row.*", *ADDED)
    )


def clean(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``df`` that break no rule, with its columns; languages are taken from ``lang`` if it is there."""
    tags = [F.col(lang).cast("string").alias("_lang")] if lang in df.columns else []
    measures = df.select(F.struct("*").alias("_row"), F.col(text).alias("_text"), *tags)
    return judge(measures, "_text", lang="_lang" if tags else None).where("kept").select("_row.*")
