"""Test conversations: from literals, JSON array files and JSON Lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.schemas import CASE, CASE_PART, MESSAGES
from corpusloom.sources.ranges import json_elements, numbered

SMOKE_PROMPTS = ("Say hello.", "사과는 무슨 색인가요?", "Write a poem of two lines.")
SMOKE_CONVERSATIONS = [
    [{"role": "system", "content": "Answer in one sentence."}, {"role": "user", "content": prompt}]
    for prompt in SMOKE_PROMPTS
]


def inline_cases(
    spark: SparkSession, conversations: Sequence[Sequence[dict[str, str]]] = SMOKE_CONVERSATIONS
) -> DataFrame:
    """(test_case, messages) from a literal list, numbered from 1."""
    rows = [
        (i, [(m["role"], m["content"]) for m in conversation])
        for i, conversation in enumerate(conversations, 1)
    ]
    return spark.createDataFrame(rows, CASE)


def read_cases(spark: SparkSession, path: str, layout: str = "lines") -> DataFrame:
    """(test_case, part, messages) from lines, (test_case, messages) from arrays.

    'lines': JSON Lines of {"test_case": n, "part": k, "messages": [...]}, split like any text
    file; a line without a part is a whole case.
    'array': one JSON array of message arrays per file, numbered from 1 over the files in the
    order of their names. A file of any size is as many tasks as it has byte ranges (`sources.ranges`);
    it is read, and its elements written once, before this returns.
    """
    if layout == "lines":
        lines = spark.read.schema(CASE_PART).json(path, mode="FAILFAST")
        return lines.withColumn("part", F.coalesce("part", F.lit(0).cast("bigint")))
    if layout != "array":
        raise ValueError(f"layout must be 'lines' or 'array', not {layout!r}")
    elements = numbered(json_elements(spark, path), "_place")
    messages = F.from_json("value", MESSAGES.simpleString(), {"mode": "FAILFAST"})
    return elements.select((F.col("_place") + 1).cast("int").alias("test_case"), messages.alias("messages"))
