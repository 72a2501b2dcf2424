"""Stored tables: layout, schemas, reading and writing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import times
from ledgerloom.functions.once import with_once
from ledgerloom.operators.ledger import LEDGER_COLUMNS, LEDGER_SCHEMA, from_json_lines, to_json_lines

STORED_LEDGER_SCHEMA = LEDGER_SCHEMA + ", captured_utc timestamp_ntz, utc_day date"


def with_instant(records: DataFrame) -> DataFrame:
    """Records as they are stored: with the parsed instant and its UTC day."""
    timed = with_once(
        records.select(*LEDGER_COLUMNS), captured_utc=times.utc_instant(F.col("captured_at"))
    )
    return timed.withColumn("utc_day", F.col("captured_utc").cast("date"))


def write_ledger(records: DataFrame, path: str, mode: str = "append") -> None:
    """Store ledger records by UTC day.

    The rebalance hint sizes files by what a day really holds: a hot day is
    split over many tasks and small days share one.
    """
    with_instant(records).hint("rebalance", "utc_day").write.mode(mode).partitionBy("utc_day").parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED_LEDGER_SCHEMA).parquet(path)


def export_ledger(records: DataFrame, path: str) -> None:
    """One canonical JSON record per line."""
    to_json_lines(records).write.text(path)


def import_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Records of exported JSON lines. Lines end at a newline only, whatever a text holds."""
    return from_json_lines(spark.read.option("lineSep", "\n").text(path))
