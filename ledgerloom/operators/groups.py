"""Ordered prefixes of groups, safe for groups that hold most of the data."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.once import with_once
from ledgerloom.functions.text import truncate_utf8
from ledgerloom.sources.scratch import stored, stored_with_size

SALTS = 32
#: Compressed keys of chosen rows that may be sent to every task.
BROADCAST_BYTES = 16 << 20


def first_rows(
    df: DataFrame, group: Sequence[str], order: Sequence[str], limit: int
) -> DataFrame:
    """First ``limit`` rows of every group, numbered from 1 in ``seq``.

    The limit is applied per task before the shuffle, then per salt, then per
    group, so the last step sees at most ``SALTS * limit`` rows of a group no
    matter how many rows the group has. All rows of a task get one salt, so a
    task sends at most ``limit`` rows of a group.
    """
    salt = F.pmod(F.spark_partition_id(), F.lit(SALTS))
    by_salt = Window.partitionBy(*group, "_salt").orderBy(*order)
    by_group = Window.partitionBy(*group).orderBy(*order)
    return (
        df.withColumn("_salt", salt)
        .withColumn("_rank", F.row_number().over(by_salt))
        .where(F.col("_rank") <= limit)
        .drop("_salt", "_rank")
        .withColumn("seq", F.row_number().over(by_group))
        .where(F.col("seq") <= limit)
    )


def chosen_rows(
    df: DataFrame, group: Sequence[str], order: Sequence[str], limit: int, texts: DataFrame | None = None
) -> DataFrame:
    """The first ``limit`` rows of every group, found by their keys before anything else is read.

    Only ``group`` and ``order`` are sorted and limited; the keys found are stored, and the rows that
    have them are taken from ``texts`` (by default ``df``), so a scan of the texts keeps the chosen ones alone.
    Rows that tie in order with the last one are taken too. The keys are broadcast if their files
    hold at most ``BROADCAST_BYTES``, else both sides are shuffled by key.
    """
    keys = [*group, *order]
    chosen, size = stored_with_size(first_rows(df.select(*keys), group, order, limit).select(*keys), "chosen")
    few = F.broadcast(chosen) if size <= BROADCAST_BYTES else chosen
    same = reduce(and_, [F.col(f"r.{key}").eqNullSafe(F.col(f"k.{key}")) for key in keys])
    return (df if texts is None else texts).alias("r").join(few.alias("k"), same, "left_semi")


def budgeted_prefix(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    bound: Callable[[Column], Column],
    max_items: int,
    total_bytes: int,
    text: str = "text",
    texts: DataFrame | None = None,
) -> DataFrame:
    """Rows of every group, in order, until the row or byte budget is spent.

    Adds ``seq``, ``bounded`` and ``bounded_bytes``. The first row is always
    kept and cut to the budget if it is larger. Sizes are not negative, so once
    the running sum passes the budget it stays there and a filter is a stop.
    Texts are read for the rows chosen by their keys, see ``chosen_rows``.
    """
    ordered = Window.partitionBy(*group).orderBy(*order)
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fits_alone = (F.col("seq") > 1) | (F.octet_length("_bound") <= total_bytes)
    first = chosen_rows(df, group, order, max_items, texts)
    return (
        with_once(first, _bound=bound(F.col(text)))
        .withColumn("seq", F.row_number().over(ordered))
        .withColumn(
            "bounded",
            F.when(fits_alone, F.col("_bound")).otherwise(
                truncate_utf8(F.col("_bound"), total_bytes)
            ),
        )
        .withColumn("bounded_bytes", F.octet_length("bounded").cast("bigint"))
        .withColumn("_used", F.sum("bounded_bytes").over(running))
        .where((F.col("_used") <= total_bytes) & (F.col("seq") <= max_items))
        .drop("_bound", "_used")
    )


def next_fit(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    bound: Callable[[Column], Column],
    max_items: int,
    total_bytes: int,
    max_batches: int,
    text: str = "text",
    texts: DataFrame | None = None,
) -> DataFrame:
    """Consecutive batches of every group: repeat ``budgeted_prefix`` on what is left.

    Adds ``seq``, ``batch_no``, ``item_no``, ``bounded`` and ``bounded_bytes``.
    One run takes at most ``max_batches`` batches, so at most
    ``max_batches * max_items`` rows of a group are chosen, by their keys, and stored with
    bounded text; the fold gathers their sizes alone and keeps the first row number of each
    batch. ``text`` itself is dropped. ``batching.whole_batches`` has no such limit.
    """
    limit = max_batches * max_items
    first = chosen_rows(df, group, order, limit, texts)
    ordered = Window.partitionBy(*group).orderBy(*order)
    sized = stored(
        with_once(first, _bound=bound(F.col(text)))
        .withColumn("_size", F.octet_length("_bound"))
        .withColumn("_alone", F.octet_length(truncate_utf8(F.col("_bound"), total_bytes)))
        .withColumn("seq", F.row_number().over(ordered))
        .drop(text),
        "sized",
    ).where(F.col("seq") <= limit)
    gathered = sized.groupBy(*group).agg(
        F.array_sort(F.collect_list(F.struct("seq", "_size", "_alone"))).alias("_rows")
    )
    start = F.struct(
        F.lit(0).alias("rows"),
        F.lit(0).cast("bigint").alias("used"),
        F.array().cast("array<int>").alias("starts"),
    )

    def step(state: Column, row: Column) -> Column:
        opens = (
            (F.size(state["starts"]) == 0)
            | (state["rows"] >= max_items)
            | (state["used"] + row["_size"] > total_bytes)
        )
        return F.when(
            opens,
            F.struct(
                F.lit(1).alias("rows"),
                row["_alone"].cast("bigint").alias("used"),
                F.concat(state["starts"], F.array(row["seq"])).alias("starts"),
            ),
        ).otherwise(
            F.struct(
                (state["rows"] + 1).alias("rows"),
                (state["used"] + row["_size"]).alias("used"),
                state["starts"].alias("starts"),
            )
        )

    starts = F.aggregate("_rows", start, step, lambda state: state["starts"])
    opened = gathered.select(*group, starts.alias("_starts"))
    same = reduce(and_, [F.col(f"r.{name}").eqNullSafe(F.col(f"s.{name}")) for name in group])
    before = F.filter("_starts", lambda first: first <= F.col("seq"))
    alone = F.col("item_no") == 1
    return (
        sized.alias("r")
        .join(opened.alias("s"), same)
        .select("r.*", "_starts")
        .withColumn("batch_no", F.size(before))
        .withColumn("item_no", F.col("seq") - F.element_at(before, -1) + 1)
        .where(F.col("batch_no") <= max_batches)
        .withColumn(
            "bounded",
            F.when(alone, truncate_utf8(F.col("_bound"), total_bytes)).otherwise(F.col("_bound")),
        )
        .withColumn("bounded_bytes", F.octet_length("bounded").cast("bigint"))
        .drop("_bound", "_size", "_alone", "_starts")
    )


def numbered(df: DataFrame, group: Sequence[str], order: Sequence[str], folder: str) -> DataFrame:
    """Number all rows of every group from 1 in ``seq``.

    The rows are sorted over the whole cluster and written once to ``folder``,
    which must be shared storage. Sorting splits by (group, order), so a group
    may span any number of files; each file holds a run of a group, and a row's
    number is its place in the run plus the rows of the group in earlier files.
    """
    df.orderBy(*group, *order).write.parquet(folder)
    name = F.col("_metadata.file_name")
    rows = df.sparkSession.read.parquet(folder).select(
        "*",
        F.regexp_extract(name, r"part-(\d+)", 1).cast("bigint").alias("_task"),
        F.regexp_extract(name, r"-c(\d+)\.", 1).cast("bigint").alias("_file"),
        F.col("_metadata.row_index").alias("_place"),
    )
    earlier = (
        Window.partitionBy(*group)
        .orderBy("_task", "_file")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    runs = (
        rows.groupBy(*group, "_task", "_file")
        .agg(F.count("*").alias("_rows"), F.min("_place").alias("_first"))
        .withColumn("_shift", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .drop("_rows")
    )
    return (
        rows.join(runs, [*group, "_task", "_file"])
        .withColumn("seq", F.col("_place") - F.col("_first") + F.col("_shift") + 1)
        .drop("_task", "_file", "_place", "_first", "_shift")
    )
