from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions.text import render_prompt_response, render_system_user
from corpusloom.operators.conversations import (
    assemble_messages,
    count_conversations,
    last_messages,
    pair_turns,
    staged_corpus,
)
from corpusloom.operators.responses import batch_responses, case_inputs, count_cases

SLOW = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
SCHEMA = "conv_id long, turn long, role string, text string"
ROLES = st.sampled_from(["user", "user", "assistant", "assistant", "system"])
TURNS = st.dictionaries(
    st.tuples(st.integers(0, 2), st.integers(0, 40)),
    st.tuples(ROLES, st.one_of(st.none(), st.sampled_from("abc"))),
    min_size=1,
    max_size=40,
)


def pairs_of(rows):
    talks = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: r[:2]):
        talks.setdefault(conv, []).append((turn, role, text))
    out = []
    for conv, turns in talks.items():
        system = next((t for _, r, t in turns if r == "system"), None)
        for (turn, role, text), (_, next_role, next_text) in zip(turns, turns[1:]):
            if (role, next_role) == ("user", "assistant"):
                out.append((conv, turn, text, next_text, system))
    return sorted(out)


def collected(df):
    return sorted(tuple(r) for r in df.collect())


@SLOW
@given(TURNS, st.sampled_from([1, 2, 3, 7, 16384]))
def test_pairs_match_plain_python_for_any_block_size(spark, turns, block):
    rows = [(c, t, r, x) for (c, t), (r, x) in turns.items()]
    df = spark.createDataFrame(rows, SCHEMA)
    want = pairs_of(rows)
    key = lambda r: tuple((v is not None, v) for v in r)
    got = [tuple(r) for r in pair_turns(df, block_turns=block).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    without = [tuple(r) for r in pair_turns(df, with_system=False, block_turns=block).collect()]
    assert sorted(without, key=key) == sorted((w[:4] for w in want), key=key)


def test_one_conversation_holding_most_turns_is_spread_over_blocks(spark):
    rng = random.Random(1)
    rows = [(7, t, rng.choice(["user", "assistant"]), f"t{t}") for t in range(3000)]
    rows += [(c, t, ["user", "assistant"][t % 2], f"c{c}t{t}") for c in range(100, 400) for t in range(4)]
    rows.append((7, 3000, "system", "late system"))
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert collected(pair_turns(df, block_turns=64)) == pairs_of(rows)
    parts = assemble_messages(df, block_turns=64)
    sizes = {(r["conv_id"], r["part"]): len(r["messages"]) for r in parts.collect()}
    assert max(sizes.values()) == 64
    assert sum(sizes.values()) == len(rows)


def test_a_long_conversation_is_one_case(spark):
    rows = [(7, t, "user", f"t{t}") for t in range(40_000)] + [(8, 0, "user", "short")]
    turns = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert {r["conv_id"]: r["content"] for r in last_messages(turns).collect()} == {7: "t39999", 8: "short"}
    assert count_conversations(turns).first()["cases"] == 2
    parts = assemble_messages(turns).withColumn("test_case", F.col("conv_id").cast("int"))
    assert parts.count() == 4 and count_cases(parts).first()["cases"] == 2
    assert {r["test_case"]: r["input"] for r in case_inputs(parts).collect()} == {7: "t39999", 8: "short"}
    answers = batch_responses(parts, lambda m: f"{len(m)} {m[0]['content']} {m[-1]['content']}").collect()
    assert {r["test_case"]: (r["input"], r["response"]) for r in answers} == {
        7: ("t39999", "40000 t0 t39999"),
        8: ("short", "1 short short"),
    }


def test_ordinary_tables_skip_the_helper_scan(spark, plan_text, tmp_path):
    rows = [(c, t, ["user", "assistant"][t % 2], "x") for c in range(5) for t in range(4)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "turns"))
    turns = spark.read.parquet(str(tmp_path / "turns"))
    assert "GreaterThanOrEqual(turn,16384)" in plan_text(pair_turns(turns))
    assert collected(pair_turns(turns)) == pairs_of(rows)


def test_messages_are_in_turn_order(spark):
    rows = [(1, 2, "assistant", "c"), (1, 0, "system", "a"), (1, 1, "user", "b"), (2, 0, "user", None)]
    got = {
        (r["conv_id"], r["part"]): [(m["role"], m["content"]) for m in r["messages"]]
        for r in assemble_messages(spark.createDataFrame(rows, SCHEMA)).collect()
    }
    assert got == {
        (1, 0): [("system", "a"), ("user", "b"), ("assistant", "c")],
        (2, 0): [("user", None)],
    }


def test_staged_corpus_keeps_every_row(spark):
    df = spark.createDataFrame([(1, 0, "system", "S"), (1, 1, "user", "U"), (1, 2, "assistant", "A")], SCHEMA)
    pairs = pair_turns(df)
    staged = staged_corpus(
        {
            "first": pairs.select(render_prompt_response("prompt", "response").alias("text")),
            "second": pairs.select(render_system_user("system_prompt", "prompt", "response").alias("text")),
        }
    )
    got = {r["stage"]: r["text"] for r in staged.collect()}
    assert set(got) == {"first", "second"}
    assert "user\nU<" in got["first"] and "user\nS\nU<" in got["second"]


def test_repeated_turns_are_ordered_by_their_content(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"), (1, 2, "user", "z")]
    for parts in (1, 4):
        df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        assert collected(pair_turns(df, with_system=False)) == [(1, 0, "q", "a")]
        assert collected(pair_turns(df, with_system=False, block_turns=1)) == [(1, 0, "q", "a")]


def test_empty_table(spark):
    assert pair_turns(spark.createDataFrame([], SCHEMA)).collect() == []
    assert assemble_messages(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("block", [2, 16384])
def test_gap_over_a_whole_block_still_pairs(spark, block):
    rows = [(1, 0, "user", "q"), (1, 11, "assistant", "a"), (1, 12, "user", "q2"), (1, 90, "assistant", "a2")]
    got = collected(pair_turns(spark.createDataFrame(rows, SCHEMA), with_system=False, block_turns=block))
    assert got == [(1, 0, "q", "a"), (1, 12, "q2", "a2")]
