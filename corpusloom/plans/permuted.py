"""Batch plans without a sort: a keyed permutation of dense row numbers, computed wherever it is needed.

The example at position p of an epoch is the row with number `perm(p)`, and the row with number i stands at
position `perm⁻¹(i)`. Both are arithmetic on one number, so the rows of any steps are known without the plan of
the others: training resumes at a step, a rank plans its own batches, and rows get their places without a shuffle.

The permutation is a Feistel network over Z_a x Z_b, the smallest a x b grid of about equal sides that holds all n
numbers: each round adds a keyed hash of one half to the other. Numbers that land behind n are sent through it
again until they don't (cycle walking); fewer than a of a x b places lie there, so that is rare.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.plans.batch_plan import PLAN_COLUMNS, BatchShape, plan_columns

ROUNDS = 6
# Odd multipliers of the round hash.
FIRST, SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Permutation:
    """A permutation of 0 to n - 1 for each epoch."""

    def __init__(self, n: int, seed: int = 0):
        if not 0 <= n < 1 << 62:
            raise ValueError(f"{n} examples: between 0 and 2**62 are possible")
        self.n, self.seed = n, seed
        self.a = max(1, math.isqrt(max(n - 1, 0)) + (math.isqrt(max(n - 1, 0)) ** 2 < n))
        self.b = max(1, -(-n // self.a))

    def _keys(self, epochs: np.ndarray) -> list[np.ndarray]:
        """For each round the key of each row's epoch."""
        found, which = np.unique(epochs, return_inverse=True)
        texts = [[f"{self.seed}-{epoch}-{k}" for epoch in found.tolist()] for k in range(ROUNDS)]
        return [np.array([int(hashlib.md5(t.encode()).hexdigest()[:16], 16) for t in row], dtype=np.uint64)[which] for row in texts]

    def _hash(self, half: np.ndarray, key: np.ndarray, size: int) -> np.ndarray:
        x = (half.astype(np.uint64) + key) * FIRST
        x = (x ^ (x >> np.uint64(32))) * SECOND
        return ((x >> np.uint64(33)) % np.uint64(size)).astype(np.int64)

    def _once(self, x: np.ndarray, keys: list[np.ndarray], back: bool) -> np.ndarray:
        left, right = x // self.b, x % self.b
        sign = -1 if back else 1
        for k in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if k % 2 == 0:
                left = (left + sign * self._hash(right, keys[k], self.a)) % self.a
            else:
                right = (right + sign * self._hash(left, keys[k], self.b)) % self.b
        return left * self.b + right

    def _walk(self, x: np.ndarray, epochs: np.ndarray, back: bool) -> np.ndarray:
        x = np.asarray(x, dtype=np.int64)
        if len(x) and not (0 <= int(x.min()) and int(x.max()) < self.n):
            raise ValueError(f"numbers must lie between 0 and {self.n - 1}")
        keys = self._keys(np.asarray(epochs))
        out, open_ = x.copy(), np.arange(len(x))
        while len(open_):
            out[open_] = self._once(out[open_], [k[open_] for k in keys], back)
            open_ = open_[out[open_] >= self.n]
        return out

    def number_at(self, positions: np.ndarray, epochs: np.ndarray) -> np.ndarray:
        return self._walk(positions, epochs, False)

    def position_of(self, numbers: np.ndarray, epochs: np.ndarray) -> np.ndarray:
        return self._walk(numbers, epochs, True)


def _column(walk) -> object:
    @F.arrow_udf("bigint")
    def column(values: pa.Array, epochs: pa.Array) -> pa.Array:
        known = values.is_valid().to_numpy(zero_copy_only=False)
        out = np.zeros(len(values), dtype=np.int64)
        x, e = (np.asarray(c.fill_null(0).to_numpy(zero_copy_only=False)).astype(np.int64) for c in (values, epochs))
        out[known] = walk(x[known], e[known])
        return pa.array(out, mask=~known)

    return column


def number_at(position: Column, epoch: Column, examples: int, seed: int = 0) -> Column:
    """The row number at a position of an epoch; null stays null."""
    return _column(Permutation(examples, seed).number_at)(position.cast("bigint"), epoch.cast("bigint"))


def position_of(number: Column, epoch: Column, examples: int, seed: int = 0) -> Column:
    """The position of a row number in an epoch; null stays null, a number that is none of the examples fails."""
    return _column(Permutation(examples, seed).position_of)(number.cast("bigint"), epoch.cast("bigint"))


def total_steps(shape: BatchShape, examples: int) -> int:
    if examples == 0:
        return 0
    return shape.max_steps if shape.max_steps > 0 else shape.epochs * shape.steps_per_epoch(examples)


def _first_of_step(shape: BatchShape, examples: int, step: int) -> int:
    """How many examples of all epochs come before a step."""
    epoch, of_epoch = divmod(step, shape.steps_per_epoch(examples))
    return epoch * examples + of_epoch * shape.examples_per_step


def permuted_plan(
    spark: SparkSession, examples: int, shape: BatchShape, *, seed: int = 0, first_step: int = 0, last_step: int | None = None, tasks: int | None = None
) -> DataFrame:
    """(number, epoch, step, accum, rank, slot) of the steps from `first_step` up to, without it, `last_step`, in their order.

    Nothing but these steps is computed, and nothing is shuffled.
    """
    end = total_steps(shape, examples)
    end = end if last_step is None else min(end, last_step)
    if first_step < 0:
        raise ValueError("first_step must be at least 0")
    first, behind = (_first_of_step(shape, examples, s) if examples else 0 for s in (min(first_step, end), end))
    every = spark.range(first, behind, 1, tasks)
    size = max(examples, 1)
    placed = every.select(F.floor(F.col("id") / size).cast("int").alias("epoch"), (F.col("id") % size).alias("position"))
    placed = placed.withColumn("number", number_at(F.col("position"), F.col("epoch"), examples, seed))
    return placed.withColumns(plan_columns(shape, size)).select("number", *PLAN_COLUMNS)


def resume(spark: SparkSession, examples: int, shape: BatchShape, step: int, **options) -> DataFrame:
    """What is left of a plan from a step on."""
    return permuted_plan(spark, examples, shape, first_step=step, **options)


def plan_rows(
    df: DataFrame, number_col: str, examples: int, shape: BatchShape, *, seed: int = 0, first_step: int = 0, last_step: int | None = None
) -> DataFrame:
    """Rows with dense numbers from 0 and their places, one row for each epoch in the asked steps; rows stay in their tasks.

    `epoch`, `step`, `accum`, `rank` and `slot` replace columns of these names.
    """
    end = total_steps(shape, examples)
    end = end if last_step is None else min(end, last_step)
    kept = [c for c in df.columns if c not in PLAN_COLUMNS and c != "position"]
    if first_step >= end:
        columns = [F.lit(0).cast(t).alias(c) for c, t in zip(PLAN_COLUMNS, ("int", "long", "int", "int", "int"))]
        return df.limit(0).select(*kept, *columns)
    per_epoch = shape.steps_per_epoch(examples)
    epochs = F.sequence(F.lit(first_step // per_epoch), F.lit((end - 1) // per_epoch))
    placed = df.select(*(F.col(f"`{c}`") for c in kept), F.explode(epochs).alias("epoch"))
    placed = placed.withColumn("position", position_of(F.col(f"`{number_col}`"), F.col("epoch"), examples, seed))
    return placed.withColumns(plan_columns(shape, examples)).where(F.col("step").between(first_step, end - 1)).drop("position").select(*(f"`{c}`" for c in kept), *PLAN_COLUMNS)
