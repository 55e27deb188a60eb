from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from corpusloom.plans.batch_plan import (
    MAX_BUCKETS,
    STAGE_SHAPES,
    BatchShape,
    batch_plan,
    bucket_count,
    epoch_positions,
    plan_summary,
)
from corpusloom.plans.numbering import number_rows
from corpusloom.plans.shards import export_shards, planned_sequences, read_shard

SLOW = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def planned(ids, shape, seed):
    mb, ga, ws = shape.micro_batch, shape.accumulation, shape.world_size
    steps = math.ceil(len(ids) / (mb * ga * ws))
    epochs = math.ceil(shape.max_steps / steps) if shape.max_steps > 0 else shape.epochs
    out = set()
    for epoch in range(epochs):
        order = sorted(ids, key=lambda i: hashlib.md5(f"{seed}-{epoch}-{i}".encode()).hexdigest())
        for pos, i in enumerate(order):
            batch = pos // mb
            local = batch // ws
            step = epoch * steps + local // ga
            if shape.max_steps <= 0 or step < shape.max_steps:
                out.add((i, epoch, step, local % ga, batch % ws, pos % mb))
    return out


def rows_of(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@SLOW
@given(
    st.integers(1, 90),
    st.integers(1, 3),
    st.integers(1, 3),
    st.integers(1, 3),
    st.integers(0, 25),
    st.integers(1, 2),
    st.sampled_from([3, 17, 500_000]),
)
def test_plan_matches_plain_python(spark, n, mb, ga, ws, max_steps, epochs, rows_per_bucket):
    ids = [i * 3 for i in range(n)]
    shape = BatchShape(mb, ga, ws, epochs, max_steps)
    df = spark.createDataFrame([(i, "x") for i in ids], "id long, payload string").repartition(3)
    got = batch_plan(df, "id", shape, seed=5, rows_per_bucket=rows_per_bucket)
    assert rows_of(got) == planned(ids, shape, 5)


def test_each_example_once_per_epoch_and_batches_not_overfull(spark):
    shape = BatchShape(micro_batch=4, accumulation=2, world_size=3, epochs=2)
    df = spark.range(1000)
    rows = batch_plan(df, "id", shape, rows_per_bucket=100).collect()
    assert Counter((r["epoch"], r["id"]) for r in rows) == Counter((e, i) for e in range(2) for i in range(1000))
    fill = Counter((r["epoch"], r["step"], r["accum"], r["rank"]) for r in rows)
    assert max(fill.values()) == 4
    summary = plan_summary(batch_plan(df, "id", shape, rows_per_bucket=100)).collect()
    assert sum(r["examples"] for r in summary) == 2000
    assert {r["examples"] for r in summary if r["step"] < 41} == {8}


def test_many_short_epochs_share_tasks(spark):
    shape = BatchShape(2, 1, 1, max_steps=500)
    df = spark.range(10)
    placed = epoch_positions(df, "id", shape, rows_per_bucket=200)
    assert placed.rdd.getNumPartitions() == 5
    assert rows_of(batch_plan(df, "id", shape, rows_per_bucket=200)) == planned(range(10), shape, 0)


def test_string_ids(spark):
    ids = [f"1-{i}" for i in range(50)]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    shape = BatchShape(2, 2, 2, epochs=1)
    assert rows_of(batch_plan(df, "id", shape, rows_per_bucket=10)) == planned(ids, shape, 0)


def test_repeated_ids_fail(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "id long")
    with pytest.raises(Exception, match="id not unique: 1"):
        batch_plan(df, "id", BatchShape(epochs=1)).collect()


def test_empty_corpus(spark):
    df = spark.createDataFrame([], "id long")
    assert batch_plan(df, "id", BatchShape()).collect() == []
    assert batch_plan(df, "id", BatchShape(max_steps=10)).collect() == []


def test_shape_rules():
    shape = BatchShape(4, 8, 8, epochs=3, max_steps=10)
    assert shape.examples_per_step == 256
    assert shape.steps_per_epoch(1000) == 4
    assert shape.epochs_needed(1000) == 3
    assert shape.last_epoch_examples(1000) == 512
    assert BatchShape(epochs=3).epochs_needed(1000) == 3
    with pytest.raises(ValueError):
        BatchShape(micro_batch=0)


def test_stage_shapes_draw_the_configured_volume(spark):
    assert STAGE_SHAPES["prompt_response"].max_steps * STAGE_SHAPES["prompt_response"].examples_per_step == 25_600
    assert STAGE_SHAPES["system_user"].max_steps * STAGE_SHAPES["system_user"].examples_per_step == 256_000
    plan = batch_plan(spark.range(25_700), "id", STAGE_SHAPES["instruction_input"], rows_per_bucket=4000)
    assert plan.count() == 25_600


def test_first_positions_stay_within_the_broadcast_bound():
    with pytest.raises(ValueError, match="rows_per_bucket"):
        bucket_count(10**12, 3, 500_000)
    assert bucket_count(10**12, 3, 5_000_000) * 3 <= MAX_BUCKETS
    assert bucket_count(10, 10**9, 500_000) == 1
    assert bucket_count(1_000_000, 3, 500_000) == 2


def test_max_steps_leaves_rows_out_before_the_shuffle(spark, plan_text):
    df = spark.range(10_000)
    shape = BatchShape(max_steps=2)
    plan = plan_text(epoch_positions(df, "id", shape, rows_per_bucket=100))
    partitions = re.search(r"direct_shuffle_partition_id\(.*?\), (\d+)\)", plan)
    # 512 of 10,000 examples are wanted, a twentieth of the 100 buckets.
    assert int(partitions.group(1)) < 12


def test_sequences_travel_before_they_are_repeated(spark, plan_text):
    df = spark.createDataFrame([(i, [i]) for i in range(100)], "id long, ids array<int>")
    plan = plan_text(planned_sequences(df, "id", BatchShape(epochs=3)))
    generates = [b for b in plan.split("\n\n") if "Generate" in b.split("\n")[0]]
    assert generates and all("ids#" not in b for b in generates)


@pytest.mark.parametrize("rows_per_file", [8, 50])
def test_shards_read_in_name_order_follow_the_plan(spark, tmp_path, rows_per_file):
    path = str(tmp_path / "shards")
    n, shape = 600, BatchShape(micro_batch=2, accumulation=2, world_size=3, epochs=2, max_steps=80)
    df = spark.createDataFrame([(i, [5 + i % 3] * (1 + i % 4) + [0]) for i in range(n)], "id long, ids array<int>")
    export_shards(df, path, "id", shape, max_length=8, rows_per_file=rows_per_file, rows_per_bucket=100, seed=3)

    back = read_shard(spark, path).select("id", "epoch", "step", "accum", "rank", "slot")
    assert rows_of(back) == planned(range(n), shape, 3)
    assert read_shard(spark, path, rank=1).where("rank <> 1").count() == 0
    steps = math.ceil(rows_per_file / 4)
    for rank in range(3):
        blocks = sorted(Path(path, f"rank={rank}").glob("block=*"))
        assert len(blocks) == math.ceil(80 / steps) and {len(b.name) for b in blocks} == {16}
        order = []
        for block in blocks:
            (f,) = block.glob("*.parquet")  # one file, whatever the number of the task that wrote it
            t = pq.ParquetFile(f).read().to_pydict()
            order += list(zip(t["step"], t["accum"], t["slot"]))
            assert {len(x) for c in ("input_ids", "attention_mask", "labels") for x in t[c]} == {8}
        assert order == sorted(order)
        assert len(order) == len(set(order))


@SLOW
@given(st.sets(st.integers(-1000, 1000), max_size=60), st.sampled_from([None, 1, 4, 32]))
def test_numbers_follow_the_key(spark, keys, ranges):
    df = spark.createDataFrame([(k, str(k)) for k in keys], "k long, v string").repartition(3)
    got = number_rows(df, "k", "n", ranges=ranges, start=1)
    assert sorted((r["k"], r["n"]) for r in got.collect()) == [(k, i) for i, k in enumerate(sorted(keys), 1)]


def test_numbers_with_two_keys_and_repeats(spark):
    df = spark.createDataFrame([(1, 0), (1, 2), (1, 1), (0, 5)], "k long, part long")
    got = number_rows(df, ["k", "part"], "n", start=0)
    assert sorted(tuple(r) for r in got.collect()) == [(0, 0, 5), (1, 1, 0), (2, 1, 1), (3, 1, 2)]
    with pytest.raises(Exception, match="k not unique: 1"):
        number_rows(df, "k", "n").collect()


def test_numbers_of_equal_first_keys_are_spread(spark):
    df = spark.range(2000).selectExpr("1 AS k", "id AS part", "concat('payload ', id) AS v").repartition(4)
    got = number_rows(df, ["k", "part"], "n", ranges=8)
    assert sorted((r["n"], r["part"], r["v"]) for r in got.collect()) == [(i + 1, i, f"payload {i}") for i in range(2000)]


def test_numbers_with_null_keys_and_no_rows(spark):
    df = spark.createDataFrame([(None, "a"), (2, "b"), (1, "c")], "k long, v string")
    assert sorted((r["n"], r["v"]) for r in number_rows(df, "k", "n").collect()) == [(1, "a"), (2, "c"), (3, "b")]
    assert number_rows(df.limit(0), "k", "n").collect() == []


def test_payload_stays_out_of_the_numbering_window(spark, plan_text):
    df = spark.createDataFrame([(1, "a")], "k long, v string")
    assert "Window" not in plan_text(number_rows(df, "k", "n").select("v"))
