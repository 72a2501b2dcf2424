"""Reproducible shuffle of a table into shards with a computable place for every row.

Rows get global numbers in key order; a keyed Feistel permutation of those numbers
is the shuffled position. The two halves of a number live in ranges a and b with
a * b just above the number of rows, and a position outside the table is permuted
again until it falls inside (cycle walking), which keeps the map one to one. Position
p lies in shard p mod shards at slot p div shards, so shard sizes differ by one row
at most, and ``row_at`` finds the row of any place without reading data.

Defined results: a null text counts as empty; rows with equal keys are told apart by
where they are read and are interchangeable; an empty table gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.once import bind
from ledgerloom.operators.groups import numbered
from ledgerloom.session import work_folder

ROUNDS = 6
#: Fewer than a points lie outside the table, so up to 64 * 64 rows this always
#: suffices; beyond, a walk this long has a chance below (1 / 64) ** 64.
WALKS = 64


@dataclass(frozen=True)
class Permutation:
    """A keyed permutation of 0 .. rows - 1 as Spark expressions."""

    rows: int
    seed: int = 0

    @property
    def a(self) -> int:
        return max(1, math.isqrt(max(self.rows, 1) - 1) + 1)

    @property
    def b(self) -> int:
        return max(1, -(-self.rows // self.a))

    def _pass(self, value: Column, backwards: bool) -> Column:
        rounds = list(range(ROUNDS))[:: -1 if backwards else 1]

        def mixed(half: Column, key: Column, modulus: int) -> Column:
            shift = F.pmod(F.xxhash64(half, F.lit(self.seed), key), F.lit(modulus))
            return F.lit(modulus) - shift if backwards else shift

        def one(state: Column, key: Column) -> Column:
            left, right = state["l"], state["r"]
            return F.when(
                key % 2 == 0,
                F.struct(((left + mixed(right, key, self.a)) % self.a).alias("l"), right.alias("r")),
            ).otherwise(
                F.struct(left.alias("l"), ((right + mixed(left, key, self.b)) % self.b).alias("r"))
            )

        def split(v: Column) -> Column:
            rest = v % self.b
            start = F.struct(((v - rest) / self.b).cast("bigint").alias("l"), rest.alias("r"))
            return F.aggregate(
                F.array(*[F.lit(k) for k in rounds]), start, one, lambda s: s["l"] * self.b + s["r"]
            )

        return bind(value.cast("bigint"), split)

    def _walk(self, value: Column, backwards: bool) -> Column:
        def again(v: Column, _: Column) -> Column:
            return F.when(v < self.rows, v).otherwise(self._pass(v, backwards))

        walked = F.aggregate(
            F.sequence(F.lit(1), F.lit(WALKS)), self._pass(value, backwards), again
        )
        return bind(
            walked,
            lambda v: F.when(v < self.rows, v).otherwise(
                F.raise_error(F.lit("cycle walk left the table; choose another seed")).cast("bigint")
            ),
        )

    def position(self, number: Column) -> Column:
        """Shuffled position of a row number."""
        return self._walk(number, backwards=False)

    def number(self, position: Column) -> Column:
        """Row number at a shuffled position."""
        return self._walk(position, backwards=True)


def row_at(permutation: Permutation, shard: Column, slot: Column, shards: int) -> Column:
    """Global number of the row at a place."""
    return permutation.number(slot * shards + shard)


def shard(df: DataFrame, keys: list[str], shards: int, seed: int = 0) -> DataFrame:
    """Add ``row_number`` (from 0, by ``keys``), ``shard`` and ``slot`` to every row.

    Only columns that the caller keeps are sorted and stored; they are kept whatever their names, but
    for the three that are added. The numbered rows lie in the shared work folder, so a lost
    executor changes no number.
    """
    spark = df.sparkSession
    kept = df.drop("row_number", "shard", "slot")
    places = [f"key{k}" for k in range(len(keys))]
    # Each row as a whole, so that none of its columns is taken for one of these.
    tied = kept.select(
        F.struct("*").alias("row"),
        *[F.col(key).alias(place) for key, place in zip(keys, places, strict=True)],
        F.monotonically_increasing_id().alias("tie"),
    )
    rows = numbered(tied, [], [*places, "tie"], f"{work_folder(spark)}/numbered")
    permutation = Permutation(rows.count(), seed)
    placed = rows.select("row", (F.col("seq") - 1).alias("number"))
    with_position = placed.withColumn("position", permutation.position(F.col("number")))
    return with_position.select(
        "row.*",
        F.col("number").alias("row_number"),
        (F.col("position") % shards).cast("int").alias("shard"),
        ((F.col("position") - F.col("position") % shards) / shards).cast("bigint").alias("slot"),
    )
