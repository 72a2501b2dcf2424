"""Intermediate rows kept in the shared work folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerloom.session import work_folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to shared storage and read back; cuts the lineage."""
    return stored_with_size(df, name)[0]


def stored_with_size(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """As ``stored``, with the bytes of the files, which a broadcast can be decided on."""
    spark = df.sparkSession
    folder = f"{work_folder(spark)}/{name}"
    df.write.parquet(folder)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    filesystem = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return spark.read.schema(df.schema).parquet(folder), filesystem.getContentSummary(path).getLength()
