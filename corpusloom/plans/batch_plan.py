"""Training batch plan: epoch, step, accumulation round, rank and slot of every example.

The order of an epoch is that of md5("seed-epoch-id"), so it depends on nothing but the ids.
A hash is spread evenly, which makes its leading digits a fair range partitioning: each
bucket of it is sorted in one task, the counts of the buckets before it give the position of
its first example. No task and no driver ever sees the whole order.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.plans.numbering import strict_row_number
from corpusloom.sinks.scratch import scratch_path

PLAN_COLUMNS = ("epoch", "step", "accum", "rank", "slot")

# Bound of the broadcast table of first positions: 1M rows of 16 bytes.
MAX_BUCKETS = 1 << 20
_HASH_RANGE = 1 << 32


@dataclass(frozen=True)
class BatchShape:
    """How many examples make a step. max_steps > 0 wins over epochs."""

    micro_batch: int = 4
    accumulation: int = 8
    world_size: int = 8
    epochs: int = 3
    max_steps: int = 0

    def __post_init__(self) -> None:
        if min(self.micro_batch, self.accumulation, self.world_size) < 1:
            raise ValueError("micro_batch, accumulation and world_size must be at least 1")

    @property
    def examples_per_step(self) -> int:
        return self.micro_batch * self.accumulation * self.world_size

    def steps_per_epoch(self, examples: int) -> int:
        """A partial last step counts as one."""
        return math.ceil(examples / self.examples_per_step)

    def epochs_needed(self, examples: int) -> int:
        if examples == 0:
            return 0
        if self.max_steps > 0:
            return math.ceil(self.max_steps / self.steps_per_epoch(examples))
        return self.epochs

    def last_epoch_examples(self, examples: int) -> int:
        """How many examples of the last epoch fall before max_steps."""
        if self.max_steps <= 0 or examples == 0:
            return examples
        full_epochs = self.epochs_needed(examples) - 1
        steps_left = self.max_steps - full_epochs * self.steps_per_epoch(examples)
        return min(examples, steps_left * self.examples_per_step)


# The batch shapes of the three training stages.
STAGE_SHAPES = {
    "prompt_response": BatchShape(micro_batch=4, accumulation=8, world_size=8, epochs=3, max_steps=100),
    "instruction_input": BatchShape(micro_batch=4, accumulation=8, world_size=8, epochs=3, max_steps=100),
    "system_user": BatchShape(micro_batch=4, accumulation=8, world_size=8, epochs=3, max_steps=1000),
}


def bucket_count(examples: int, epochs: int, rows_per_bucket: int) -> int:
    """Buckets per epoch; more than MAX_BUCKETS of all epochs together fail, as larger ones are asked for."""
    wanted = max(1, math.ceil(examples / rows_per_bucket))
    if wanted > 1 and wanted * epochs > MAX_BUCKETS:
        raise ValueError(f"{wanted * epochs} buckets, more than {MAX_BUCKETS}: use a larger rows_per_bucket")
    return wanted


def _shuffled_keys(
    df: DataFrame, id_col: str, seed: int, epochs: int, buckets: int, epochs_per_part: int
) -> DataFrame:
    """One row per epoch and example with its order key and its partition number `_part`."""
    digest = F.md5(
        F.concat_ws("-", F.lit(str(seed)), F.col("epoch").cast("string"), F.col(id_col).cast("string"))
    )
    if buckets == 1:
        part = F.floor(F.col("epoch") / epochs_per_part)
    else:
        leading = F.conv(F.substring("_hex", 1, 8), 16, 10).cast("long")
        part = F.col("epoch") * buckets + F.floor(leading * buckets / _HASH_RANGE)
    # Never null, which spares a filter on it, and with that a second md5 per row.
    part = F.coalesce(part.cast("int"), F.lit(0))
    return (
        df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
        .withColumn("_hex", digest)
        .withColumns({"_key": F.unhex("_hex"), "_part": part})
        .drop("_hex")
    )


def epoch_positions(
    df: DataFrame,
    id_col: str,
    shape: BatchShape,
    *,
    seed: int = 0,
    examples: int | None = None,
    rows_per_bucket: int = 500_000,
) -> DataFrame:
    """All columns of df, plus `epoch` and the 0-based `position` in it.

    One shuffle of the rows. Examples behind max_steps are left out before it, bucket by
    bucket, and exactly after it. Output partitions follow each other in order, each sorted by
    epoch and position. `examples` saves the count when it is known.
    """
    n = df.count() if examples is None else examples
    epochs = shape.epochs_needed(n)
    if epochs == 0:
        return df.limit(0).select("*", F.lit(0).alias("epoch"), F.lit(0).cast("long").alias("position"))
    buckets = bucket_count(n, epochs, rows_per_bucket)
    # A short epoch is one bucket, and several of them share a task.
    epochs_per_part = max(1, rows_per_bucket // n) if buckets == 1 else 1
    parts = epochs * buckets if buckets > 1 else math.ceil(epochs / epochs_per_part)
    last, last_examples = epochs - 1, shape.last_epoch_examples(n)
    layout = (id_col, seed, epochs, buckets, epochs_per_part)

    rows = _shuffled_keys(df, *layout)
    firsts = None
    if buckets > 1:
        counts = (
            _shuffled_keys(df.select(id_col), *layout)
            .groupBy("epoch", "_part")
            .agg(F.count("*").alias("_n"))
        )
        before = W.partitionBy("epoch").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
        firsts = counts.select(
            "epoch", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")
        )
        # Written once: looked at here, and sent to all tasks below.
        path = scratch_path(df.sparkSession, "first-positions")
        firsts.write.parquet(path)
        firsts = df.sparkSession.read.schema(firsts.schema).parquet(path)
        if last_examples < n:
            # Highest bucket of the last epoch that still has examples before max_steps.
            needed = firsts.where((F.col("epoch") == last) & (F.col("_first") < last_examples))
            parts = needed.agg(F.max("_part")).first()[0] + 1
            rows = rows.where(F.col("_part") < parts)
            firsts = firsts.where(F.col("_part") < parts)
    in_bucket = W.partitionBy("_part", "epoch").orderBy("_key", id_col)
    placed = rows.repartitionById(parts, "_part").withColumn(
        "_number", strict_row_number(in_bucket, [id_col]).cast("long")
    )
    if firsts is None:
        placed = placed.withColumn("position", F.col("_number") - 1)
    else:
        # At most MAX_BUCKETS rows by construction of `buckets`.
        placed = placed.join(F.broadcast(firsts.select("_part", "_first")), "_part").withColumn(
            "position", F.col("_first") + F.col("_number") - 1
        )
    if last_examples < n:
        placed = placed.where((F.col("epoch") < last) | (F.col("position") < last_examples))
    return placed.select(*df.columns, "epoch", "position")


def plan_columns(shape: BatchShape, examples: int) -> dict[str, Column]:
    """step, accum, rank and slot from epoch and position."""
    position = F.col("position")
    batch = F.floor(position / shape.micro_batch)
    local = F.floor(batch / shape.world_size)
    step = F.col("epoch") * shape.steps_per_epoch(examples) + F.floor(local / shape.accumulation)
    return {
        "step": step.cast("long"),
        "accum": (local % shape.accumulation).cast("int"),
        "rank": (batch % shape.world_size).cast("int"),
        "slot": (position % shape.micro_batch).cast("int"),
    }


def batch_plan(
    df: DataFrame,
    id_col: str,
    shape: BatchShape,
    *,
    seed: int = 0,
    rows_per_bucket: int = 500_000,
) -> DataFrame:
    """(id, epoch, step, accum, rank, slot), planned on the id column alone."""
    ids = df.select(id_col)
    n = ids.count()
    placed = epoch_positions(
        ids, id_col, shape, seed=seed, examples=n, rows_per_bucket=rows_per_bucket
    )
    return placed.withColumns(plan_columns(shape, max(n, 1))).select(id_col, *PLAN_COLUMNS)


def plan_summary(plan: DataFrame) -> DataFrame:
    """Examples per step and rank."""
    return plan.groupBy("step", "rank").agg(F.count("*").alias("examples"))
