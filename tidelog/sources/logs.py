"""Access-log text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line of a file, folder or prefix: ``value``."""
    return spark.read.text(path)


def read_replay_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines for a replay, with bytes that are not UTF-8 replaced, and their ``file``."""
    return spark.read.text(path).select(
        F.make_valid_utf8("value").alias("value"), F.col("_metadata.file_path").alias("file")
    )


def stream_lines(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """The same lines as a stream of the files that arrive under ``path``."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)
