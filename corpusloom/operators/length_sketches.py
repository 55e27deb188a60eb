"""Length quantiles of a growing corpus from one mergeable sketch for each of its files.

A table keeps (file, examples, total, min_length, max_length, sketch) for every file seen. New files add their rows and
the others are not read again; statistics of the whole corpus are aggregates over this table. The sketches give each
quantile within their rank error. Where it has to be exact, one scan counts what lies below the range that the sketch
leaves open, and the lengths inside that range one by one.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SKETCH_SIZE = 400


def rank_error(k: int = SKETCH_SIZE) -> float:
    """The error of a rank that a KLL sketch of this size exceeds in one of a hundred cases, as its authors give it."""
    return 2.446 / k**0.9021


def _same_name(file: str) -> str:
    return re.sub(r"^(\w+):/+", r"\1:/", file)


def sketch_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of all files seen; None before the first."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def update_sketches(spark: SparkSession, read: Callable[[list[str] | None], DataFrame], length: Column, path: str, k: int = SKETCH_SIZE) -> list[str]:
    """Adds the files that `path` does not know yet and returns them.

    `read(None)` is the whole corpus, `read(files)` these files of it. A file counts as it is when it is added. A job that
    fails adds nothing. Null lengths are left out, and a file without a length has a row without a sketch's values.
    """
    seen = sketch_table(spark, path)
    known = set() if seen is None else {_same_name(r["file"]) for r in seen.select("file").collect()}  # as many names as a scan lists
    new = [f for f in read(None).inputFiles() if _same_name(f) not in known]
    if not new:
        return []
    lengths = read(new).select(F.col("_metadata.file_path").alias("file"), length.cast("bigint").alias("length"))
    rows = lengths.groupBy("file").agg(
        F.count("length").alias("examples"),
        F.sum("length").alias("total"),
        F.min("length").alias("min_length"),
        F.max("length").alias("max_length"),
        F.kll_sketch_agg_bigint("length", k).alias("sketch"),
    )
    names = spark.createDataFrame([(f, _same_name(f)) for f in new], "given string, name string")
    made = rows.withColumn("name", F.regexp_replace("file", r"^(\w+):/+", "$1:/")).drop("file")
    # Files without a row are known as well, or they would be read each time.
    made = names.join(made, "name", "left").select(F.col("given").alias("file"), F.coalesce("examples", F.lit(0)).alias("examples"), "total", "min_length", "max_length", "sketch")
    made.write.mode("append").parquet(path)
    return new


def sketched_stats(spark: SparkSession, path: str) -> DataFrame:
    """Count, least, largest and mean length of all files, from their rows alone."""
    seen = sketch_table(spark, path)
    if seen is None:
        raise ValueError(f"no sketches in {path}")
    return seen.agg(
        F.sum("examples").alias("examples"), F.min("min_length").alias("min_length"), F.max("max_length").alias("max_length"), (F.sum("total") / F.sum("examples")).alias("avg_length")
    )


def sketched_quantiles(spark: SparkSession, path: str, per_mille: Sequence[int], k: int = SKETCH_SIZE) -> DataFrame:
    """(per_mille, length, low, high): quantiles by the sketches, and the lengths between which the true one lies but for rare cases."""
    seen = sketch_table(spark, path)
    if seen is None:
        raise ValueError(f"no sketches in {path}")
    error = rank_error(k)
    merged = seen.where("examples > 0").agg(F.kll_merge_agg_bigint("sketch", k).alias("sketch"), F.sum("examples").alias("n")).where("n > 0")

    def quantile(at: float) -> Column:
        return F.kll_sketch_get_quantile_bigint("sketch", F.lit(min(max(at, 0.0), 1.0)))

    of = [
        F.struct(F.lit(p).alias("per_mille"), *(quantile(p / 1000 + e).alias(name) for name, e in (("length", 0.0), ("low", -error), ("high", error)))) for p in per_mille
    ]
    return merged.select(F.inline(F.array(*of)))


def exact_quantiles(spark: SparkSession, df: DataFrame, length: Column, path: str, per_mille: Sequence[int], k: int = SKETCH_SIZE) -> DataFrame:
    """(per_mille, length): the least length that so many of a thousand rows, counted up, do not exceed.

    `df` is the corpus of the sketches. Where the true value lies outside of the range that its sketch gives, as it may in rare
    cases, the range is opened to all lengths and counted again.
    """
    lengths = df.select(length.cast("bigint").alias("length")).where("length IS NOT NULL")
    ranges = [(r["per_mille"], r["low"], r["high"]) for r in sketched_quantiles(spark, path, per_mille, k).collect()]
    found, n = _counted(lengths, ranges)
    missed = {p for p, *_ in ranges} - {r["per_mille"] for r in found.collect()}
    if not missed or not n:
        return found
    ends = lengths.agg(F.min("length"), F.max("length")).first()
    more, _ = _counted(lengths, [(p, *ends) for p in sorted(missed)])
    return found.unionByName(more)


def _counted(lengths: DataFrame, ranges: list[tuple[int, int, int]]) -> tuple[DataFrame, int]:
    """One scan: rows below each range, and the histogram inside of it, at most a row for each length."""
    spark = lengths.sparkSession
    schema = "per_mille int, length bigint"
    below = [F.count_if(F.col("length") < low).alias(str(i)) for i, (_, low, _) in enumerate(ranges)]
    counts = lengths.agg(F.count("*").alias("n"), *below).first()
    if not counts["n"]:
        return spark.createDataFrame([], schema), 0
    table = spark.createDataFrame([(p, low, high, counts[str(i)]) for i, (p, low, high) in enumerate(ranges)], "per_mille int, low bigint, high bigint, below bigint")
    histogram = lengths.groupBy("length").agg(F.count("*").alias("rows"))
    inside = histogram.join(F.broadcast(table), F.col("length").between(F.col("low"), F.col("high")))
    up_to = Window.partitionBy("per_mille").orderBy("length")
    reached = inside.withColumn("reached", F.col("below") + F.sum("rows").over(up_to))
    wanted = F.col("per_mille") * counts["n"]
    # The first length that reaches the rank; none if it was reached below the range already.
    hits = reached.where((F.col("reached") * 1000 >= wanted) & ((F.col("below") * 1000 < wanted) | (F.col("below") == 0)))
    return hits.groupBy("per_mille").agg(F.min("length").alias("length")), counts["n"]
