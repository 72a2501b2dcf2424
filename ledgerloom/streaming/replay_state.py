"""Replay conflicts in a stream, by keyed state.

The state holds the content hash of every record id seen, so an id that comes again is told
to be a duplicate or, with other content, a conflict, also across restarts. With a time to live the state is
bounded by what came within it; a record that comes again later counts as new and is left
to the store's offsets.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SCHEMA = "record_id string, content_sha256 string, status string"


class ReplayState(StatefulProcessor):
    """Status of each record: new, duplicate or conflict with the first content of its id."""

    def __init__(self, ttl_millis: int | None) -> None:
        self.ttl_millis = ttl_millis

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "content_sha256 string", self.ttl_millis)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        first = self.seen.get()[0] if self.seen.exists() else None
        for some in rows:
            # Rows that come together have no order of their own; the least content is the first.
            ordered = some.sort_values("content_sha256", kind="stable")
            statuses = []
            for content in ordered["content_sha256"]:
                if first is None:
                    first = content
                    self.seen.update((content,))
                    statuses.append("new")
                else:
                    statuses.append("duplicate" if content == first else "conflict")
            yield pd.DataFrame(
                {"record_id": ordered["record_id"], "content_sha256": ordered["content_sha256"], "status": statuses}
            )

    def close(self) -> None:
        pass


def configure(spark) -> None:
    """Keyed state needs a state store on disk."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)


def replay_status(records: DataFrame, ttl_millis: int | None = None) -> DataFrame:
    """(record_id, content_sha256, status) of a stream of records with an id and a content hash, neither null."""
    configure(records.sparkSession)
    return (
        records.select("record_id", "content_sha256")
        .groupBy("record_id")
        .transformWithStateInPandas(
            statefulProcessor=ReplayState(ttl_millis),
            outputStructType=SCHEMA,
            outputMode="Append",
            timeMode="None" if ttl_millis is None else "ProcessingTime",
        )
    )


def refuse_conflicts(statuses: DataFrame) -> DataFrame:
    """The new records; a conflict fails the batch."""
    conflict = F.raise_error(F.concat(F.lit("conflicting record "), "record_id")).cast("boolean")
    return statuses.where(F.when(F.col("status") == "conflict", conflict).otherwise(F.col("status") == "new"))
