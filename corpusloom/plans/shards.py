"""Planned model inputs written per rank."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.model_inputs import pad_and_label
from corpusloom.plans.batch_plan import PLAN_COLUMNS, BatchShape, batch_plan
from corpusloom.schemas import DEFAULT_MAX_LENGTH
from corpusloom.sinks.scratch import scratch_path

ROWS_PER_FILE = 4096


def planned_sequences(
    sequences: DataFrame, id_col: str, shape: BatchShape, *, seed: int = 0, rows_per_bucket: int = 500_000
) -> DataFrame:
    """Closed, unpadded sequences with their place in the training run.

    The plan is made of the ids alone. The sequences travel once to meet it, however many epochs
    there are, and are repeated by epoch behind that.
    """
    plan = batch_plan(sequences, id_col, shape, seed=seed, rows_per_bucket=rows_per_bucket)
    return sequences.join(plan, id_col)


def export_shards(
    sequences: DataFrame,
    path: str,
    id_col: str,
    shape: BatchShape,
    *,
    ids_col: str = "ids",
    seed: int = 0,
    max_length: int = DEFAULT_MAX_LENGTH,
    eos_id: int = 0,
    pad_id: int | None = None,
    rows_per_file: int = ROWS_PER_FILE,
    rows_per_bucket: int = 500_000,
) -> None:
    """Write model inputs under rank=<r>/block=<steps>/, padded on the way out.

    A block is a run of steps of which a rank has about `rows_per_file` examples, and one file. Its
    number has ten digits, so the blocks of a rank in name order give its examples by step,
    accumulation round and slot, and their number depends on the steps alone. The sequences are
    written to the scratch folder first and computed once.
    """
    spark = sequences.sparkSession
    staged = scratch_path(spark, "sequences")
    sequences = sequences.select(id_col, ids_col)
    sequences.write.parquet(staged)
    fixed = spark.read.schema(sequences.schema).parquet(staged)
    steps = max(1, math.ceil(rows_per_file / (shape.micro_batch * shape.accumulation)))
    planned = planned_sequences(fixed, id_col, shape, seed=seed, rows_per_bucket=rows_per_bucket)
    block = F.lpad(F.floor(F.col("step") / steps).cast("string"), 10, "0")
    dealt = planned.withColumn("block", block).repartition("rank", "block")
    pad_and_label(
        dealt.sortWithinPartitions("rank", "block", "step", "accum", "slot"),
        ids_col,
        max_length=max_length,
        eos_id=eos_id,
        pad_id=pad_id,
        keep=[id_col, *PLAN_COLUMNS, "block"],
    ).write.mode("overwrite").partitionBy("rank", "block").parquet(path)


def read_shard(spark: SparkSession, path: str, rank: int | None = None) -> DataFrame:
    """An export read back; with a rank, only that directory is read."""
    df = spark.read.parquet(path).drop("block")
    return df if rank is None else df.where(F.col("rank") == rank)
