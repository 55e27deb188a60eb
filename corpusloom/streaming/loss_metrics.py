"""Metric extraction over log lines, the same for a table and for a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.functions.metrics import COMPAT_METRICS, metric_entries
from corpusloom.sources.logs import stream_logs


def extract_metrics(
    lines: DataFrame,
    definitions: Sequence[tuple[str, str]] = COMPAT_METRICS,
    line_col: str = "value",
    keep: Sequence[str] = (),
) -> DataFrame:
    """(keep..., metric, value): one row per line and definition that matches.

    A capture that is not a number gives a null value. Stateless, so it runs on a stream as is.
    """
    return lines.select(*keep, F.explode(metric_entries(line_col, definitions)).alias("entry")).select(
        *keep, "entry.metric", "entry.value"
    )


def start_metric_stream(
    spark: SparkSession,
    log_dir: str,
    out_dir: str,
    checkpoint_dir: str,
    definitions: Sequence[tuple[str, str]] = COMPAT_METRICS,
    *,
    interval: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Follow a log directory and append (line, metric, value) to Parquet, exactly once.

    With an interval the stream keeps running; without one it handles what is there and stops.
    """
    lines = stream_logs(spark, log_dir, max_files_per_trigger).withColumnRenamed("value", "line")
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return (
        extract_metrics(lines, definitions, line_col="line", keep=["line"])
        .writeStream.format("parquet")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint_dir)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )
