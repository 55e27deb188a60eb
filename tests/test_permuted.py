"""Plans by a keyed permutation: a bijection at every size, the tail of a plan alone, no shuffle."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.plans.batch_plan import BatchShape
from corpusloom.plans.permuted import Permutation, permuted_plan, plan_rows, position_of, resume, total_steps

SHAPE = BatchShape(micro_batch=2, accumulation=3, world_size=2, epochs=3)


@pytest.mark.parametrize("n", [*range(1, 70), 99, 100, 101, 1000, 4097, 123_457])
def test_every_epoch_is_a_bijection_and_goes_back(n):
    perm = Permutation(n, seed=n)
    assert perm.a * perm.b >= n and perm.a * perm.b - n < max(perm.a, perm.b)
    for epoch in (0, 1):
        epochs = np.full(n, epoch)
        numbers = perm.number_at(np.arange(n), epochs)
        assert (np.sort(numbers) == np.arange(n)).all()
        assert (perm.position_of(numbers, epochs) == np.arange(n)).all()


def test_orders_look_shuffled_and_depend_on_seed_and_epoch():
    n = 20_000
    orders = [Permutation(n, s).number_at(np.arange(n), np.full(n, e)) for s, e in ((0, 0), (0, 1), (1, 0))]
    for i, order in enumerate(orders):
        assert abs(np.corrcoef(np.arange(n), order)[0, 1]) < 0.03
        assert abs(np.corrcoef(order[:-1], order[1:])[0, 1]) < 0.03
        assert (order == np.arange(n)).sum() < 20
        assert all((order == other).sum() < 20 for other in orders[:i])
    halves = np.array([len(np.intersect1d(order[:1000], np.arange(1000))) for order in orders])
    assert (abs(halves - 50) < 40).all()


def test_numbers_outside_fail():
    with pytest.raises(ValueError):
        Permutation(5).number_at(np.array([5]), np.array([0]))
    with pytest.raises(ValueError):
        Permutation(1 << 63)


def test_large_numbers():
    perm = Permutation(10**15 + 7)
    x = np.array([0, 1, 10**15, 10**15 + 6, 123_456_789_012])
    assert (perm.position_of(perm.number_at(x, np.zeros(5)), np.zeros(5)) == x).all()


def rows(plan) -> list[tuple]:
    return sorted(tuple(r) for r in plan.collect())


@pytest.mark.parametrize("n,shape", [(50, SHAPE), (12, SHAPE), (7, BatchShape(2, 3, 2, max_steps=4)), (100, BatchShape(4, 1, 2, max_steps=5))])
def test_resumed_plan_is_the_tail_of_the_plan(spark, n, shape):
    whole = rows(permuted_plan(spark, n, shape, seed=3))
    steps = total_steps(shape, n)
    assert {r[2] for r in whole} == set(range(steps))
    for step in range(steps + 2):
        assert rows(resume(spark, n, shape, step, seed=3)) == [r for r in whole if r[2] >= step]
    middle = permuted_plan(spark, n, shape, seed=3, first_step=1, last_step=3)
    assert rows(middle) == [r for r in whole if 1 <= r[2] < 3]


def test_an_epoch_holds_every_row_once_and_a_batch_its_size(spark):
    plan = permuted_plan(spark, 50, SHAPE, seed=1)
    per_epoch = plan.groupBy("epoch").agg(F.count("*").alias("n"), F.countDistinct("number").alias("d")).collect()
    assert [(r["n"], r["d"]) for r in per_epoch] == [(50, 50)] * 3
    sizes = plan.groupBy("step", "accum", "rank").agg(F.max("slot").alias("m"), F.count("*").alias("n")).collect()
    assert all(r["n"] <= 2 and r["m"] == r["n"] - 1 for r in sizes)


def test_rows_get_the_places_of_the_plan_without_a_shuffle(spark, plan_text):
    df = spark.range(50).select(F.col("id").alias("n"), F.lit("x").alias("step"), F.concat(F.lit("row "), "id").alias("payload"))
    placed = plan_rows(df, "n", 50, SHAPE, seed=3, first_step=2, last_step=9)
    assert "Exchange" not in plan_text(placed)
    assert "Exchange" not in plan_text(permuted_plan(spark, 50, SHAPE, seed=3))
    got = sorted((r["n"], r["epoch"], r["step"], r["accum"], r["rank"], r["slot"]) for r in placed.collect())
    assert got == rows(permuted_plan(spark, 50, SHAPE, seed=3, first_step=2, last_step=9))
    assert all(r["payload"] == f"row {r['n']}" for r in placed.collect())


def test_nothing_to_plan(spark):
    assert rows(permuted_plan(spark, 0, SHAPE)) == []
    assert rows(resume(spark, 5, SHAPE, 99)) == []
    assert plan_rows(spark.range(0), "id", 0, SHAPE).collect() == []
    null = spark.range(1).select(position_of(F.lit(None), F.lit(0), 5).alias("p"))
    assert null.first()["p"] is None
