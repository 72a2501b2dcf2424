"""Mixing of sources to target weights by thresholds on document hashes.

A source takes all its documents a whole number of times and, for the rest of its target,
those whose hash lies below a threshold. The threshold comes from histograms: words are
summed by source and hash bucket, the bucket that the budget ends in is split into buckets
of its own, and so on until it holds one document, which is taken if that is nearer to the
target. Only the rows of the last bucket are looked at again, nothing is sorted, and a
source of any size is summed in parts.

Thresholds of one seed are nested: a smaller target takes a part of what a larger one takes.

Defined results: a null text has no words; rows without a source are a source of their
own, the last; a document's hash is that of its id and text, and rows equal in both are
told apart by where they are read, so as many of them are taken as the target asks for;
sources without words have target 0; an empty table gives no rows; columns of the
input are kept, and ones named like an added column are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.rules import words_of
from ledgerloom.llm.store import stored
from ledgerloom.operators.groups import numbered
from ledgerloom.session import work_folder

BITS = 10
#: A hash has 60 bits, so six levels; six more tell equal rows apart.
LEVELS = 6
ADDED = ("size", "source_size", "target", "copies", "taken", "_k1", "_k2")


@dataclass(frozen=True)
class Recipe:
    """Weights of the sources in code-point order, repeating; the mix's share of all words; the most repeats."""

    weights: Sequence[float] = (3, 1, 2)
    share: float = 1.5
    repeats: int = 2


def keyed(df: DataFrame, seed: int = 0, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Add the size in words and the hash keys."""

    def top(value: Column) -> Column:
        return F.shiftrightunsigned(value, 64 - BITS * LEVELS)

    return df.drop(*ADDED).select(
        "*",
        F.size(words_of(F.col(text_column))).cast("bigint").alias("size"),
        top(F.xxhash64(F.lit(seed), F.col(id_column), F.col(text_column))).alias("_k1"),
        top(F.xxhash64(F.lit(seed), F.monotonically_increasing_id())).alias("_k2"),
    )


def targets(slim: DataFrame, recipe: Recipe, source_column: str = "source") -> DataFrame:
    """(source, source_size, target) with the excess over the most repeats reshared."""
    spark = slim.sparkSession
    sums = slim.groupBy(F.col(source_column).alias("_source")).agg(
        F.sum("size").alias("source_size"), F.count("*").alias("rows")
    )
    ranked = numbered(
        sums.withColumn("_last", F.col("_source").isNull()), [], ["_last", "_source"], f"{work_folder(spark)}/sources"
    )
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in recipe.weights]),
        (F.pmod(F.col("seq") - 1, F.lit(len(recipe.weights))) + 1).cast("int"),
    )
    weighted = stored(ranked.withColumn("weight", weight).drop("_last", "seq"), "sources")
    most = (F.col("source_size") * recipe.repeats).cast("double")
    total = weighted.agg(F.sum("source_size"), F.sum("weight")).first()
    budget = recipe.share * (total[0] or 0)
    level = budget / total[1] if total[1] else 0.0
    while True:
        full = F.col("weight") * level > most
        sums_now = weighted.agg(F.sum(F.when(full, most)), F.sum(F.when(~full, F.col("weight")))).first()
        if not sums_now[1]:
            break
        raised = (budget - (sums_now[0] or 0.0)) / sums_now[1]
        if raised <= level:
            break
        level = raised
    return weighted.select("_source", "source_size", F.least(most, F.col("weight") * level).alias("target"))


def _step(active: DataFrame, budgets: DataFrame, key: str, shift: int) -> DataFrame:
    """The bucket in which each source's budget ends: its start, rows, words and the budget inside."""
    bucket = F.shiftright(F.col(key), shift)
    histogram = active.groupBy("_source", bucket.alias("bucket")).agg(
        F.sum("size").alias("words"), F.count("*").alias("rows")
    )
    upto = Window.partitionBy("_source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        histogram.withColumn("upto", F.sum("words").over(upto))
        .join(budgets.withColumnRenamed("_source", "_of"), F.col("_source").eqNullSafe(F.col("_of")))
        .where("upto > left")
        .withColumn("_first", F.row_number().over(Window.partitionBy("_source").orderBy("bucket")))
        .where("_first = 1")
        .select(
            "_source",
            F.shiftleft("bucket", shift).alias("start"),
            "rows",
            "words",
            (F.col("left") - F.col("upto") + F.col("words")).alias("left"),
        )
    )


def thresholds(slim: DataFrame, goals: DataFrame) -> DataFrame:
    """(source, source_size, target, whole, t1, t2): rows with a key below (t1, t2) are taken once more."""
    size = F.greatest(F.col("source_size"), F.lit(1))
    whole = stored(
        goals.withColumn("whole", F.floor(F.col("target") / size).cast("int")).withColumn(
            "left", F.col("target") - F.col("whole") * F.col("source_size")
        ),
        "whole",
    )
    active, budgets = slim, whole.where("left > 0").select("_source", "left")
    fixed = None
    fixed_first = F.lit(0).cast("bigint")
    for step in range(2 * LEVELS):
        key = "_k1" if step < LEVELS else "_k2"
        shift = BITS * (LEVELS - 1 - step % LEVELS)
        ends = _step(active, budgets, key, shift)
        if step < LEVELS:
            ends = ends.withColumn("t1", F.col("start")).withColumn("t2", F.lit(0).cast("bigint"))
        else:
            known = budgets.select(F.col("_source").alias("_of"), F.col("_t1").alias("t1"))
            ends = ends.join(known, F.col("_source").eqNullSafe(F.col("_of"))).drop("_of")
            ends = ends.withColumn("t2", F.col("start"))
        ends = stored(ends, "ends")
        last = step == 2 * LEVELS - 1
        # One row decides by itself; its bucket is taken if that is nearer to the target.
        after = F.when(F.col("left") * 2 >= F.col("words"), F.shiftleft(F.lit(1).cast("bigint"), shift)).otherwise(0)
        done = ends.where(F.lit(last) | (F.col("rows") == 1))
        end = done.select(
            "_source",
            (F.col("t1") + (after if step < LEVELS else fixed_first)).alias("t1"),
            (F.col("t2") + (after if step >= LEVELS else fixed_first)).alias("t2"),
        )
        fixed = end if fixed is None else fixed.union(end)
        open_ends = ends.where(~(F.lit(last) | (F.col("rows") == 1)))
        if last or open_ends.limit(1).count() == 0:
            break
        inside = open_ends.select(F.col("_source").alias("_of"), "start")
        active = stored(
            active.join(
                inside,
                F.col("_source").eqNullSafe(F.col("_of"))
                & (F.shiftright(F.col(key), shift) == F.shiftright(F.col("start"), shift)),
            ).drop("_of", "start"),
            "active",
        )
        budgets = open_ends.select("_source", "left", F.col("t1").alias("_t1"))
    kept = fixed.withColumnRenamed("_source", "_of")
    return whole.join(kept, F.col("_source").eqNullSafe(F.col("_of")), "left").select(
        "_source",
        "source_size",
        "target",
        "whole",
        F.coalesce("t1", F.lit(0).cast("bigint")).alias("t1"),
        F.coalesce("t2", F.lit(0).cast("bigint")).alias("t2"),
    )


def apply_thresholds(rows: DataFrame, plan: DataFrame, source_column: str = "source") -> DataFrame:
    """Add ``source_size``, ``target``, ``copies`` and ``taken`` to keyed rows."""
    below = (F.col("_k1") < F.col("t1")) | ((F.col("_k1") == F.col("t1")) & (F.col("_k2") < F.col("t2")))
    copies = (F.col("whole") + F.when(below, 1).otherwise(0)).cast("int")
    return (
        rows.join(plan, F.col(source_column).eqNullSafe(F.col("_source")))
        .withColumn("copies", copies)
        .withColumn("taken", (F.col("copies") * F.col("size")).cast("bigint"))
        .drop("_source", "whole", "t1", "t2", "_k1", "_k2")
    )


def mix(
    df: DataFrame,
    recipe: Recipe = Recipe(),
    seed: int = 0,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
) -> DataFrame:
    """All rows with how often the mix takes each (``copies``) and how many words that is (``taken``).

    ``df`` is read twice and must give its rows in the same order, as stored tables do: rows
    of one key are told apart by their place. Other columns are kept, whatever their names.
    """
    # Each row as a whole, so that none of its columns is taken for one of these.
    whole = df.select(
        F.struct(*[F.col(f"`{name}`") for name in df.columns if name not in ADDED[:5]]).alias("_row"),
        F.col(id_column).alias("_id"),
        F.col(source_column).alias("_from"),
        F.col(text_column).alias("_text"),
    )
    rows = keyed(whole, seed, "_id", "_text")
    slim = stored(rows.select(F.col("_from").alias("_source"), "size", "_k1", "_k2"), "sizes")
    plan = stored(thresholds(slim, targets(slim, recipe, "_source")), "thresholds")
    found = apply_thresholds(rows, plan, "_from")
    return found.select("_row.*", "size", "source_size", "target", "copies", "taken")


def mixed(df: DataFrame, recipe: Recipe = Recipe(), seed: int = 0) -> DataFrame:
    """The rows of the mix, each as often as it is taken, with the columns of ``df``."""
    rows = df.select(F.struct("*").alias("_row"), "doc_id", "source", "text")
    taken = mix(rows, recipe, seed).where("copies > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("_row.*")
