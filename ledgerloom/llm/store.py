"""Tables kept in the shared work folder, and grouped Arrow passes over sorted rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.session import work_folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to shared storage and read back; cuts the lineage."""
    path = f"{work_folder(df.sparkSession)}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def group_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups of rows that arrive sorted by ``keys``, one at a time."""
    pending: list[pa.RecordBatch] = []

    def key_of(batch: pa.RecordBatch, row: int) -> tuple:
        return tuple(batch.column(k)[row].as_py() for k in keys)

    for batch in batches:
        if batch.num_rows == 0:
            continue
        changes = np.zeros(batch.num_rows, dtype=bool)
        for k in keys:
            column = batch.column(k)
            values = column.to_numpy(zero_copy_only=False)
            changes[1:] |= values[1:] != values[:-1]
        cuts = [0, *np.flatnonzero(changes).tolist(), batch.num_rows]
        if pending and key_of(pending[-1], pending[-1].num_rows - 1) != key_of(batch, 0):
            yield pa.Table.from_batches(pending)
            pending = []
        for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
            if start > 0:
                yield pa.Table.from_batches(pending)
                pending = []
            pending.append(batch.slice(start, stop - start))
    if pending:
        yield pa.Table.from_batches(pending)


def by_group(
    df: DataFrame, keys: list[str], work: Callable[[pa.Table], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """``work`` on every group; rows of a group meet in one task, sorted, and stream through it."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in group_runs(batches, keys):
            result = work(group)
            if result is not None and result.num_rows:
                yield result

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(apply, schema)
