"""Digests of sets that grow, kept as sums.

A member is hashed into lanes of 24 bits, and a set's digest is the sum of its members' lanes and
their number. Sums of parts add up to the sum of the whole in any order, and a
member that leaves is taken off again, so a set that is stored run by run is hashed at the cost of what
changed. The digest finds changes; it is not meant to withstand a search for two sets of one digest.
A lane holds the sum of 2 ** 39 members of one part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.ident import sha256_hex
from ledgerloom.functions.once import with_once

#: Each hash gives ten lanes of six hex digits.
HASHES = 4
_PER_HASH = 10
LANES = HASHES * _PER_HASH
_MODULUS = 1 << 24
SCHEMA = "members bigint, lanes array<bigint>"


def lanes(member: Column) -> Column:
    """A member's lanes."""

    def lane(name: Column, place: int) -> Column:
        return F.conv(F.substring(name, 6 * place + 1, 6), 16, 10).cast("bigint")

    hashes = [sha256_hex(F.concat(F.lit(f"{k}:"), member)) for k in range(HASHES)]
    return F.flatten(
        F.transform(F.array(*hashes), lambda name: F.array(*[lane(name, place) for place in range(_PER_HASH)]))
    )


def _sums(keys: Sequence[str], rows: DataFrame, sign: Column, count: Column) -> DataFrame:
    totals = [F.sum(sign * F.get("lanes", F.lit(k))).alias(f"lane{k}") for k in range(LANES)]
    summed = rows.groupBy(*keys).agg(F.sum(count).cast("bigint").alias("members"), *totals)
    return summed.select(
        *keys, "members", F.array(*[F.pmod(F.col(f"lane{k}"), F.lit(_MODULUS)) for k in range(LANES)]).alias("lanes")
    )


def summed(rows: DataFrame, keys: Sequence[str], member: Column, leaves: Column | None = None) -> DataFrame:
    """(keys, members, lanes) of rows; rows for which ``leaves`` holds are taken off. Null members count as empty."""
    kept = with_once(rows, lanes=lanes(F.coalesce(member, F.lit(""))))
    sign = F.lit(1) if leaves is None else F.when(leaves, -1).otherwise(1)
    return _sums(keys, kept, sign, sign)


def combined(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sums of stored parts (keys, members, lanes)."""
    return _sums(keys, parts, F.lit(1), F.col("members"))


def digest(members: Column, lanes: Column) -> Column:
    """Hash of a set's number of members and lanes; that of the empty text for no members, or null."""
    body = F.concat_ws(":", members.cast("string"), F.array_join(lanes.cast("array<string>"), ","))
    return F.when(F.coalesce(members, F.lit(0)) == 0, sha256_hex(F.lit(""))).otherwise(sha256_hex(body))
