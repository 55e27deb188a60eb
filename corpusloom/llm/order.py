"""Positions of rows within their group in sorted order, for groups of any size."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from corpusloom.llm.common import staged


def _local(batches: Iterable[pa.RecordBatch], group: str) -> Iterator[pa.RecordBatch]:
    part, last, count, lead = TaskContext.get().partitionId(), None, 0, True
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        keys = batch.column(group)
        new = np.zeros(n, dtype=bool)
        new[1:] = pc.not_equal(keys.slice(1), keys.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        first = keys[0].as_py()
        new[0] = first != last
        if not new[0]:
            start = -count
        else:
            lead, start = last is None, 0
        starts = np.where(new, np.arange(n), np.iinfo(np.int64).min)
        starts[0] = start
        starts = np.maximum.accumulate(starts)
        leads = np.zeros(n, dtype=bool)
        if lead:
            after = np.flatnonzero(new[1:])
            leads[: after[0] + 1 if len(after) else n] = True
            lead = len(after) == 0
        at = np.arange(n) - starts
        last, count = keys[n - 1].as_py(), int(at[-1]) + 1
        columns = [*batch.columns, pa.array(at, pa.int64()), pa.array(np.full(n, part, dtype=np.int32)), pa.array(leads)]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "_at", "_part", "_lead"])


def positions(df: DataFrame, group: str, order: list[str], keep: list[str], name: str = "position") -> DataFrame:
    """The columns ``keep`` of ``df`` and ``name``: places from 0 of the rows of each ``group`` by ``order``.

    ``group`` holds no nulls and is among ``keep``. Rows are range-partitioned by group and order
    together, so that a group of any size takes as many tasks as it needs, and numbered task by task;
    only the group that a task begins with has rows in earlier tasks, and the counts of those, one row
    for each task, are broadcast. Equal rows are dealt by a number of their own, as any order of them is right.
    """
    numbered = df.withColumn("_copy", F.monotonically_increasing_id())
    keys = [F.col(group), *(F.col(c) for c in order), F.col("_copy")]
    sorted_ = numbered.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*keep)
    added = [StructField("_at", LongType()), StructField("_part", IntegerType()), StructField("_lead", BooleanType())]
    schema = StructType([*df.select(*keep).schema.fields, *added])
    local = staged(sorted_.mapInArrow(lambda batches: _local(batches, group), schema), "positions")
    leads = local.where("_lead").select(group).distinct()
    counts = local.join(F.broadcast(leads), group, "left_semi").groupBy(group, "_part").agg(F.count("*").alias("_n"))
    before = W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    carry = counts.select(group, "_part", F.sum("_n").over(before).alias("_before")).where("_before > 0")
    out = local.join(F.broadcast(carry), [group, "_part"], "left")
    return out.select(*keep, (F.col("_at") + F.coalesce("_before", F.lit(0))).alias(name))
