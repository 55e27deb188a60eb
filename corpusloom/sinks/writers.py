"""Results, cases, corpora, model inputs and run summaries as files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.responses import as_results
from corpusloom.schemas import RESULT
from corpusloom.sinks.scratch import scratch_path
from corpusloom.sources.corpora import CSV_NULL, CSV_OPTIONS


def write_results(responses: DataFrame, path: str) -> None:
    """JSON Lines of test_case, input and response in case order; null responses keep their key.

    A sort reads its input twice, to sample and to sort. The responses are therefore written to
    the scratch folder first, so that the user function answers each case once.
    """
    spark = responses.sparkSession
    staged = scratch_path(spark, "responses")
    as_results(responses).write.parquet(staged)
    spark.read.schema(RESULT).parquet(staged).orderBy("test_case").write.mode("overwrite").option(
        "ignoreNullFields", "false"
    ).json(path)


# The file name of a message list and the pattern of its time stamp.
MESSAGE_FILE = "test_messages.json"
STAMP = "%Y%m%d-%H%M%S"


def message_key(base: str, at: datetime | None = None, name: str = MESSAGE_FILE) -> str:
    """`<base>/<yyyyMMdd-HHmmss>/<name>`."""
    return f"{base.rstrip('/')}/{(at or datetime.now()).strftime(STAMP)}/{name}"


def write_cases(cases: DataFrame, base: str, at: datetime | None = None) -> str:
    """Cases as JSON Lines under a time-stamped key, a line for each part; returns the path, which may be any Hadoop URI."""
    path = message_key(base, at)
    cases.select(*[c for c in ("test_case", "part", "messages") if c in cases.columns]).write.mode("overwrite").option(
        "ignoreNullFields", "false"
    ).json(path)
    return path


def write_corpus(df: DataFrame, path: str, format: str = "parquet", **options: str) -> None:
    """A corpus with its `split` column as one directory per split.

    CSV keeps every text as it is: texts are quoted, blanks stay, and a null is a mark of its own;
    a text that equals the mark fails the job.
    """
    if format == "csv":
        options = {**CSV_OPTIONS, "quoteAll": "true", **options}
        marked = F.raise_error(F.lit("a text equals the mark of a null")).cast("string")
        df = df.withColumns(
            {c: F.when(F.col(c) == CSV_NULL, marked).otherwise(F.col(c)) for c, kind in df.dtypes if kind == "string" and c != "split"}
        )
    df.write.mode("overwrite").format(format).options(**options).partitionBy("split").save(path)


def write_model_inputs(
    model_inputs: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = (),
    partitions: int | None = None,
) -> None:
    """Model inputs as Parquet. The rows are wide: spread them only if the input has too few splits."""
    out = model_inputs if partitions is None else model_inputs.repartition(partitions)
    out.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_summary(spark: SparkSession, metrics: Mapping[str, object] | DataFrame, path: str) -> None:
    """One JSON row of run metrics, from a dict or a one-row table."""
    row = metrics if isinstance(metrics, DataFrame) else spark.createDataFrame([dict(metrics)])
    row.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
