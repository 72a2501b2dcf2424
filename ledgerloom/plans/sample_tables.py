"""The driver's tables read as session logs, documents and decisions.

Conversations are turned into event lines of rotating logs: a log holds 16
conversations and 1,000 turns of each, so no log depends on how long the longest
conversation is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.operators import ledger
from ledgerloom.session import configure, work_folder
from ledgerloom.sources import byte_ranges, tables

ZONE = "Asia/Seoul"

_written: dict[tuple[str, str, str], str] = {}


def stored_once(
    name: str, spark: SparkSession, sf: str, build: Callable[[], DataFrame], texts: bool = False
) -> DataFrame:
    """A derived table that is stored in the work folder on first use and read from there.

    Tables that hold whole ``texts`` are written where they were read, without a shuffle of their own.
    """
    path = _once(
        name, spark, sf, lambda path: (build() if texts else build().hint("rebalance")).write.parquet(path)
    )
    return spark.read.parquet(path)


def _once(name: str, spark: SparkSession, sf: str, write: Callable[[str], None]) -> str:
    """Path of a derived table in the shared work folder; written on first use."""
    key = (name, spark.sparkContext.applicationId, sf)
    if key not in _written:
        path = f"{work_folder(spark)}/{name}"
        write(path)
        _written[key] = path
    return _written[key]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def iso_utc(wall_time: Column) -> Column:
    """A timestamp without zone as an ISO string with ``Z``."""
    text = wall_time.cast("timestamp_ntz").cast("string")
    return F.concat(F.replace(text, F.lit(" "), F.lit("T")), F.lit("Z"))


def _event_json(timestamp: Column, role: Column, body: Column, turn: Column) -> Column:
    def event(content: Column) -> Column:
        payload = F.struct(F.lit("message").alias("type"), role.alias("role"), content.alias("content"))
        return F.to_json(
            F.struct(timestamp.alias("timestamp"), F.lit("response_item").alias("type"), payload.alias("payload"))
        )

    def part(kind: str) -> Column:
        return F.struct(F.lit(kind).alias("type"), body.alias("text"))

    return (
        F.when(turn == 0, event(body))
        .when(role == "user", event(F.array(part("input_text"))))
        .when(role == "assistant", event(F.array(part("output_text"), part("reasoning"))))
        .otherwise(event(F.struct(body.alias("text"))))
    )


def event_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as lines (source, byte_start, byte_end, raw) plus conv_id, turn."""
    minutes = F.col("conv_id") * 37 + F.col("turn")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    captured = iso_utc(start + F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"), F.lit(0)))
    source = F.format_string(
        "log-%06d-%03d.jsonl", F.expr("conv_id div 16"), F.expr("turn div 1000")
    )
    in_log = (
        Window.partitionBy("source")
        .orderBy("conv_id", "turn")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        table(spark, sf, "conversations")
        .select(
            "conv_id",
            "turn",
            source.alias("source"),
            F.concat(
                _event_json(captured, F.col("role"), F.col("text"), F.col("turn")), F.lit("\n")
            ).alias("line"),
        )
        .withColumn("bytes", F.octet_length("line").cast("bigint"))
        .withColumn("byte_end", F.sum("bytes").over(in_log))
        .select(
            "conv_id",
            "turn",
            "source",
            (F.col("byte_end") - F.col("bytes")).alias("byte_start"),
            "byte_end",
            F.col("line").cast("binary").alias("raw"),
        )
    )


def parsed_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Ledger records parsed from the event lines in this query."""
    return ledger.ledger_records(event_lines(spark, sf))


def sample_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """The stored ledger of the sample logs, written once per session."""
    path = _once("ledger", spark, sf, lambda path: tables.write_ledger(parsed_ledger(spark, sf), path))
    return tables.read_ledger(spark, path)


def _write_logs(lines: DataFrame, path: str) -> None:
    """Log files with an unfinished last line.

    Every line ends in "}", so with that as the row separator each row starts
    with the newline of the line before it and the file ends without one.
    """
    newline = F.when(F.col("byte_start") > 0, "\n").otherwise("")
    open_line = F.regexp_replace(F.col("raw").cast("string"), r"\}\n\z", "")
    (
        lines.select(
            F.regexp_replace("source", r"\.jsonl$", "").alias("log"),
            "byte_start",
            F.concat(newline, open_line).alias("value"),
        )
        .repartition("log")
        .sortWithinPartitions("log", "byte_start")
        .drop("byte_start")
        .write.partitionBy("log")
        .option("lineSep", "}")
        .text(path)
    )


def log_folder(spark: SparkSession, sf: str) -> str:
    """Folder of log files with the conversations, written once per session."""
    return _once("logs", spark, sf, lambda path: _write_logs(event_lines(spark, sf), path))


def listed_logs(spark: SparkSession, sf: str) -> DataFrame:
    """Files of ``log_folder`` under the names the event lines use."""
    files = byte_ranges.list_sources(spark, log_folder(spark, sf), "*.txt")
    name = F.concat(F.regexp_extract("source", r"log=([^/]+)/", 1), F.lit(".jsonl"))
    return files.withColumn("source", name)
