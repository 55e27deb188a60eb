"""How many tasks read a source."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows over `partitions` tasks, or as the source is split.

    A small Parquet file is often one row group, hence one task, however many cores wait.
    """
    return df if partitions is None else df.repartition(partitions)
