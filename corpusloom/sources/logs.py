"""Job log lines, as files read once or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """(value): one row per line."""
    return spark.read.text(path)


def stream_logs(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """(value): lines of the files that arrive in a directory."""
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path)
