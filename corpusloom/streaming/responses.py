"""Responses to test cases that survive a stopped job: a stream of case files and a journal of what was answered.

Each micro-batch takes some files, leaves out the cases that the journal has, calls the responder for the others and writes
its part of the journal, `batch=<number>`, as a whole or not at all. A job that starts again with the same checkpoint goes on
with the first batch that was not finished; one that starts without it reads all files once more, but calls the
responder only for cases without a result. A batch that was written before the stream could note so is not answered again.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.operators.responses import batch_responses
from corpusloom.schemas import CASE_PART

JOURNAL = "test_case int, input string, response string, error string"


def read_journal(spark: SparkSession, journal: str) -> DataFrame:
    """(test_case, input, response, error): one row for each answered case; a case that failed and was tried again has its last row."""
    try:
        rows = spark.read.schema(f"{JOURNAL}, batch string").parquet(journal)
    except AnalysisException:  # nothing was written yet
        return spark.createDataFrame([], JOURNAL)
    last = rows.groupBy("test_case").agg(F.max_by(F.struct("input", "response", "error"), "batch").alias("last"))
    return last.select("test_case", "last.*")


def _is_written(spark: SparkSession, path: str) -> bool:
    """Whether a writer has finished this folder."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def _job(spark: SparkSession, checkpoint: str) -> str:
    """A number of the job that began the checkpoint, kept beside it; later jobs have larger ones."""
    try:
        return spark.read.text(f"{checkpoint}/job").first()["value"]
    except AnalysisException:
        job = f"{time.time_ns():020d}"
        spark.createDataFrame([(job,)], "value string").write.text(f"{checkpoint}/job")
        return job


def start_responses(
    spark: SparkSession,
    cases: str,
    journal: str,
    checkpoint: str,
    responder: Callable | None = None,
    *,
    setup: Callable[[], Callable] | None = None,
    files_per_batch: int = 1,
    partitions: int | None = None,
    batch_size: int | None = None,
    retry_errors: bool = False,
) -> StreamingQuery:
    """Answer all case files (JSON Lines of test_case, part and messages) in a folder and stop.

    All parts of a case stand in one file. `retry_errors` tries cases again that the journal has an error for, in a job with a new
    checkpoint. The other options are those of `batch_responses`. Broken lines stop the job, and so does an error in `setup`.
    """
    job = _job(spark, checkpoint)

    def answer(lines: DataFrame, number: int) -> None:
        session = lines.sparkSession
        path = f"{journal}/batch={job}-{number:012d}"
        if _is_written(session, path):
            return
        parts = lines.withColumn("part", F.coalesce("part", F.lit(0).cast("bigint")))
        done = read_journal(session, journal)
        done = done.where("error IS NULL") if retry_errors else done
        todo = parts.join(done.select("test_case"), "test_case", "left_anti")
        batch_responses(todo, responder, setup=setup, partitions=partitions, batch_size=batch_size).write.mode("overwrite").parquet(path)

    reader = spark.readStream.schema(CASE_PART).option("mode", "FAILFAST").option("maxFilesPerTrigger", files_per_batch)
    stream = reader.json(cases).writeStream.foreachBatch(answer).option("checkpointLocation", f"{checkpoint}/stream")
    return stream.trigger(availableNow=True).start()
