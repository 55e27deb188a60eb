"""Quantiles of files that come one after the other, against sorted lists."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.length_sketches import exact_quantiles, rank_error, sketched_quantiles, sketched_stats, update_sketches

ASKED = [1, 100, 250, 500, 900, 990, 1000]


def true_quantile(values: list[int], per_mille: int) -> int:
    values = sorted(values)
    return values[-(-per_mille * len(values) // 1000) - 1]


@pytest.fixture
def corpus(spark, tmp_path):
    folder = str(tmp_path / "corpus")

    def add(lengths: list) -> None:
        df = spark.createDataFrame([(None if n is None else "x" * n,) for n in lengths], "text string")
        df.coalesce(1).write.mode("append").parquet(folder)

    return folder, add, lambda files: spark.read.parquet(*(files or [folder]))


def test_files_are_added_without_reading_the_others(spark, tmp_path, corpus):
    folder, add, read = corpus
    path, rng = str(tmp_path / "sketches"), random.Random(2)
    asked: list = []

    def reading(files):
        asked.append(files)
        return read(files)

    values = []
    for k in range(3):
        new = [int(rng.lognormvariate(4, 1)) for _ in range(4000)]
        values += new
        add([*new, None])
        added = update_sketches(spark, reading, F.length("text"), path)
        assert len(added) == 1 and asked[-1] == added
    assert update_sketches(spark, reading, F.length("text"), path) == [] and asked[-1] is None
    stats = sketched_stats(spark, path).first()
    assert (stats["examples"], stats["min_length"], stats["max_length"]) == (12_000, min(values), max(values))
    assert abs(stats["avg_length"] - sum(values) / 12_000) < 1e-9
    ordered, error = sorted(values), rank_error()
    for r in sketched_quantiles(spark, path, ASKED).collect():
        low, high = sum(v < r["length"] for v in values) / 12_000, sum(v <= r["length"] for v in values) / 12_000
        assert low - error <= r["per_mille"] / 1000 <= high + error
        assert r["low"] <= true_quantile(ordered, r["per_mille"]) <= r["high"]
    got = {r["per_mille"]: r["length"] for r in exact_quantiles(spark, read(None), F.length("text"), path, ASKED).collect()}
    assert got == {p: true_quantile(values, p) for p in ASKED}


@pytest.mark.parametrize("values", [[5], [0, 0, 0, 7], [3] * 50, list(range(10)), [None, 4, None]])
def test_few_and_equal_lengths(spark, tmp_path, corpus, values):
    folder, add, read = corpus
    add(values)
    path = str(tmp_path / "sketches")
    update_sketches(spark, read, F.length("text"), path)
    known = [v for v in values if v is not None]
    got = {r["per_mille"]: r["length"] for r in exact_quantiles(spark, read(None), F.length("text"), path, ASKED).collect()}
    assert got == {p: true_quantile(known, p) for p in ASKED}


def test_a_range_that_misses_is_opened(spark, tmp_path, corpus):
    """Sketches of another corpus give ranges that are off; the result is right nevertheless."""
    folder, add, read = corpus
    add(list(range(100)))
    path = str(tmp_path / "sketches")
    update_sketches(spark, read, F.length("text"), path)
    other = spark.range(500).select(F.repeat(F.lit("x"), (F.col("id") + 200).cast("int")).alias("text"))
    got = {r["per_mille"]: r["length"] for r in exact_quantiles(spark, other, F.length("text"), path, [100, 500, 1000]).collect()}
    assert got == {p: true_quantile(list(range(200, 700)), p) for p in (100, 500, 1000)}


def test_no_rows(spark, tmp_path, corpus):
    folder, add, read = corpus
    add([None, None])
    path = str(tmp_path / "sketches")
    assert len(update_sketches(spark, read, F.length("text"), path)) == 1
    assert update_sketches(spark, read, F.length("text"), path) == []
    assert exact_quantiles(spark, read(None), F.length("text"), path, [500]).collect() == []
    with pytest.raises(ValueError):
        sketched_stats(spark, str(tmp_path / "none"))
