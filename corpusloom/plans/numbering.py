"""Row numbers over a whole table without sending it through one task."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.sinks.scratch import scratch_path

ROWS_PER_RANGE = 200_000


def strict_row_number(window: WindowSpec, keys: Sequence[str]) -> Column:
    """row_number over a window ordered by unique keys; the job fails where the keys repeat."""
    number = F.row_number().over(window)
    repeated = number > 1
    for key in keys:
        repeated &= F.lag(key).over(window).eqNullSafe(F.col(key))
    shown = F.concat_ws(", ", *[F.col(key).cast("string") for key in keys])
    message = F.concat(F.lit(f"{', '.join(keys)} not unique: "), shown)
    return F.when(repeated, F.raise_error(message)).otherwise(number)


def number_keys(df: DataFrame, keys: Sequence[str], number_col: str, *, start: int = 1, ranges: int | None = None) -> DataFrame:
    """(keys, number): consecutive numbers of unique keys in their order.

    Only the keys travel. Range partitioning looks at all of them, so rows that agree in the
    first one are still spread. Ranges are numbered apart and written once, so that every later
    read sees the same ones; the counts of the ranges before give the first number of each.
    """
    spark = df.sparkSession
    ids = df.select(*keys)
    if ranges is None:
        ranges = max(1, math.ceil(ids.count() / ROWS_PER_RANGE))
    ranged = ids.repartitionByRange(ranges, *keys).withColumn("_range", F.spark_partition_id())
    in_range = W.partitionBy("_range").orderBy(*keys)
    numbered = ranged.withColumn("_number", strict_row_number(in_range, keys))
    path = scratch_path(spark, "numbers")
    numbered.write.parquet(path)
    numbered = spark.read.schema(numbered.schema).parquet(path)
    # One row for each range.
    counts = numbered.groupBy("_range").agg(F.count("*").alias("_n"))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    firsts = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    number = F.col("_before") + F.col("_number") + (start - 1)
    return numbered.join(firsts, "_range").select(*keys, number.alias(number_col))


def number_rows(
    df: DataFrame,
    order_by: str | Sequence[str],
    number_col: str = "test_case",
    *,
    start: int = 1,
    ranges: int | None = None,
) -> DataFrame:
    """Consecutive int numbers in the order of unique keys; the other columns are joined afterwards."""
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    numbers = number_keys(df, keys, "_n", start=start, ranges=ranges)
    numbers = numbers.select(F.col("_n").cast("int").alias("_number"), *[F.col(k).alias(f"_key_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    out = df.drop(number_col) if number_col not in keys else df
    return out.join(numbers, same).select(F.col("_number").alias(number_col), *[c for c in df.columns if c != number_col])
