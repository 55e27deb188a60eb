"""Corpus statistics as one partial and one final aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from corpusloom.functions.sequences import real_length, supervised_count


def _stats(length: Column) -> list[Column]:
    return [
        F.count("*").alias("examples"),
        F.min(length).alias("min_length"),
        F.max(length).alias("max_length"),
        F.avg(length).alias("avg_length"),
    ]


def count_examples(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("examples"))


def padded_length_stats(model_inputs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Lengths of the padded ids: all equal to max_length, as a padded table reports them."""
    return model_inputs.groupBy(*by).agg(*_stats(F.size("input_ids")))


def masked_length_stats(model_inputs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Real lengths of a padded table, from the attention mask."""
    return model_inputs.groupBy(*by).agg(*_stats(real_length("attention_mask")))


def real_length_stats(
    sequences: DataFrame,
    ids_col: str = "ids",
    *,
    max_length: int,
    pad_id: int = 0,
    n_tokens_col: str = "n_tokens",
    by: Sequence[str] = (),
    with_total: bool = False,
) -> DataFrame:
    """Real lengths, truncated rows and supervised labels of closed, unpadded sequences.

    With `with_total` a last row per column of `by` is rolled up; its group columns are null.
    """
    grouped = sequences.rollup(*by) if with_total and by else sequences.groupBy(*by)
    return grouped.agg(
        *_stats(F.size(ids_col)),
        F.count_if(F.col(n_tokens_col) >= max_length).alias("truncated"),
        F.sum(supervised_count(ids_col, pad_id)).alias("supervised"),
    )


def stats_line(row: Row) -> str:
    """The statistics row as text, mean with two decimals of the exact binary value."""
    if row["examples"] == 0:
        return "Total examples: 0"
    return (
        f"Total examples: {row['examples']}, sequence length min {row['min_length']}, "
        f"max {row['max_length']}, avg {row['avg_length']:.2f}"
    )
