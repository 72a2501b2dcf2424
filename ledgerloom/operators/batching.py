"""Next-fit batches of whole groups, of any size, without gathering a group.

Where a batch ends that begins at a row is a boundary in the prefix sums of the sizes, and it lies at
most ``max_items`` rows on. So the rows of a group are numbered over the cluster and cut into blocks,
each with the first rows of the next one beside it, and a block finds, for each row that may be
its first start, which row the chain of batches enters the next block at and how many batches
lie between. Pointer doubling over these entries finds the true one of every block and its
batch number in a logarithmic number of joins of a few rows a block. Then
every block numbers its rows.

Only keys and sizes are moved; the texts stay where they are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.once import with_once
from ledgerloom.functions.text import truncate_utf8
from ledgerloom.operators.groups import numbered
from ledgerloom.session import work_folder
from ledgerloom.sources.scratch import stored

BLOCK_ROWS = 1 << 14


def _sorted(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    table = table.sort_by("seq")
    return table, table.column("seq").to_numpy()


def _following(table: pa.Table, max_items: int, total_bytes: int) -> np.ndarray:
    """For each row, as a batch's first, the place of the next batch's first row; past the end if there is none."""
    size = table.column("size").to_numpy().astype(np.int64)
    alone = table.column("alone").to_numpy().astype(np.int64)
    sums = np.cumsum(size)
    boundary = np.searchsorted(sums, sums + total_bytes - alone, "right")
    return np.minimum(boundary, np.arange(len(size)) + max_items)


def _named(table: pa.Table, group: Sequence[str], count: int) -> list[pa.Array]:
    """The group's columns, repeated."""
    first = pa.array(np.zeros(count, np.int64))
    return [table.column(name).combine_chunks().take(first) for name in group]


def _exits(group: Sequence[str], block_rows: int, max_items: int, total_bytes: int):
    names = [*group, "block", "entry", "exit", "hops", "last"]

    def work(table: pa.Table) -> pa.Table:
        table, seq = _sorted(table)
        block = table.column("block")[0].as_py()
        end = (block + 1) * block_rows
        own = int(np.searchsorted(seq, end, "right"))
        following = _following(table, max_items, total_bytes)
        where, hops, last = following.copy(), np.ones(own, np.int64), np.arange(own)
        for row in range(own - 1, -1, -1):
            onward = following[row]
            if onward < own:
                where[row], hops[row], last[row] = where[onward], hops[onward] + 1, last[onward]
        entries = np.arange(min(own, max_items) if block else 1)
        reached = where[entries]
        found = [seq[r] if r < len(seq) else None for r in reached.tolist()]
        columns = [
            *_named(table, group, len(entries)),
            pa.array(np.full(len(entries), block, np.int64)),
            pa.array(seq[entries]),
            pa.array(found, pa.int64()),
            pa.array(hops[entries]),
            pa.array(seq[last[entries]]),
        ]
        return pa.Table.from_arrays(columns, names=names)

    return work


def _numbering(columns: Sequence[str], block_rows: int, max_items: int, total_bytes: int):
    def work(rows: pa.Table, known: pa.Table) -> pa.Table:
        if rows.num_rows == 0:
            none = pa.array([], pa.int64())
            return rows.select(list(columns)).append_column("batch_no", none).append_column("item_no", none)
        rows, seq = _sorted(rows)
        block = rows.column("block")[0].as_py()
        own = int(np.searchsorted(seq, (block + 1) * block_rows, "right"))
        following = _following(rows, max_items, total_bytes)
        entry, number, before, before_number = (
            known.column(c)[0].as_py() for c in ("entry", "number", "before", "before_number")
        )
        starts = [] if before is None else [before]
        at = int(np.searchsorted(seq, entry)) if entry is not None else own
        while at < own:
            starts.append(int(seq[at]))
            at = int(following[at])
        first_number = before_number if before is not None else number
        place = np.searchsorted(starts, seq[:own], "right") - 1
        kept = rows.slice(0, own).select(list(columns))
        batch = pa.array((place + first_number).astype(np.int64))
        item = pa.array((seq[:own] - np.array(starts, np.int64)[place] + 1).astype(np.int64))
        return kept.append_column("batch_no", batch).append_column("item_no", item)

    return work


def _entries(exits: DataFrame, group: Sequence[str], blocks: int) -> DataFrame:
    """(group, block, entry, number): the true first start of every block and its batch number."""
    reached = exits.where("block = 0").select(*group, "entry", F.lit(1).cast("bigint").alias("number"))
    jumps = exits.where("exit IS NOT NULL").select(*group, "entry", "exit", "hops")
    steps = 1
    while steps < blocks:
        onward = reached.join(jumps, [*group, "entry"]).select(
            *group, F.col("exit").alias("entry"), (F.col("number") + F.col("hops")).alias("number")
        )
        reached = stored(reached.unionByName(onward), "reached")
        steps *= 2
        if steps < blocks:
            second = jumps.select(*group, F.col("entry").alias("exit"), F.col("exit").alias("far"), F.col("hops").alias("more"))
            jumps = stored(
                jumps.join(second, [*group, "exit"]).select(
                    *group, "entry", F.col("far").alias("exit"), (F.col("hops") + F.col("more")).alias("hops")
                ),
                "jumps",
            )
    return reached


def number_batches(
    rows: DataFrame, group: Sequence[str], max_items: int, total_bytes: int, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Add ``batch_no`` and ``item_no`` to stored rows (group, seq, size, alone and others).

    ``seq`` numbers the rows of a group from 1; ``alone`` is a row's size as the first of a batch and at
    most ``total_bytes``. A row opens a batch if the batch has ``max_items`` rows or would pass the bytes.
    """
    block_rows = max(block_rows, 2 * max_items)
    place = F.col("seq") - 1
    block = F.floor(place / block_rows)
    beside = (block > 0) & (place % block_rows < max_items)
    held = F.when(beside, F.array(block, block - 1)).otherwise(F.array(block))
    sent = rows.withColumn("seq", F.col("seq").cast("bigint")).select("*", F.explode(held).alias("block"))
    schema = {f.name: f.dataType.simpleString() for f in rows.schema}
    keys = ", ".join(f"`{name}` {schema[name]}" for name in group)
    sizes = sent.select(*group, "block", "seq", "size", "alone")
    exits = stored(
        sizes.groupBy(*group, "block").applyInArrow(
            _exits(group, block_rows, max_items, total_bytes),
            f"{keys}, block bigint, entry bigint, exit bigint, hops bigint, last bigint",
        ),
        "exits",
    )
    blocks = (exits.agg(F.max("block")).first()[0] or 0) + 1
    true = _entries(exits, group, blocks).join(exits, [*group, "entry"])
    # A batch may reach into a block, which at a group's end may have no start of its own.
    own = true.select(*group, "block", "entry", "number", F.lit(None).cast("bigint").alias("before"), F.lit(None).cast("bigint").alias("before_number"))
    carried = true.select(
        *group, (F.col("block") + 1).alias("block"), F.lit(None).cast("bigint").alias("entry"), F.lit(None).cast("bigint").alias("number"),
        F.col("last").alias("before"), (F.col("number") + F.col("hops") - 1).alias("before_number"),
    )
    known = own.unionByName(carried).groupBy(*group, "block").agg(
        *[F.max(c).alias(c) for c in ("entry", "number", "before", "before_number")]
    )
    columns = rows.columns
    output = ", ".join(f"`{name}` {'bigint' if name == 'seq' else schema[name]}" for name in columns)
    return (
        sent.groupBy(*group, "block")
        .cogroup(known.groupBy(*group, "block"))
        .applyInArrow(
            _numbering(columns, block_rows, max_items, total_bytes), f"{output}, batch_no bigint, item_no bigint"
        )
    )


def whole_batches(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    bound: Callable[[Column], Column],
    max_items: int,
    total_bytes: int,
    text: str = "text",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(group, order, seq, size, alone, batch_no, item_no) of all rows: ``next_fit`` without a limit of batches.

    Groups and order must not be null, and ``order`` must tell the rows of a group apart.
    """
    sized = (
        with_once(df, _bound=bound(F.col(text)))
        .withColumn("size", F.octet_length("_bound").cast("bigint"))
        .withColumn("alone", F.octet_length(truncate_utf8(F.col("_bound"), total_bytes)).cast("bigint"))
        .select(*group, *order, "size", "alone")
    )
    rows = stored(sized, "sizes")
    placed = numbered(rows, group, order, f"{work_folder(df.sparkSession)}/numbered")
    return number_batches(stored(placed, "placed"), group, max_items, total_bytes, block_rows)
