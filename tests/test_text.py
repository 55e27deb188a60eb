from __future__ import annotations

import sys
import unicodedata
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import text as tx
from corpusloom.schemas import INSTRUCTION_INPUT, PROMPT_RESPONSE, SYSTEM_USER

SLOW = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def framed(prompt, answer):
    turns = [f"<|im_start|>{role}\n{text}<|im_end|>" for role, text in (("user", prompt), ("assistant", answer))]
    return "\n".join(turns)


def column(df, c):
    return [r[0] for r in df.select(c).collect()]


def test_blank_covers_exactly_what_strip_removes(spark):
    points = [c for c in range(1, sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame([(c, chr(c)) for c in points if c < 0x20000], "code int, text string")
    blank = {r["code"] for r in df.where(tx.is_blank("text")).collect()}
    assert blank == {c for c in points if c < 0x20000 and not chr(c).strip()}
    assert len(blank) == 29


def test_blank_and_non_empty_side_by_side(spark):
    df = spark.createDataFrame([("",), (" \t\n",), ("\u200b",), (" x ",), (None,)], "t string")
    assert column(df, tx.is_blank(F.coalesce("t", F.lit("")))) == [True, True, False, False, True]
    assert column(df, tx.is_non_empty("t")) == [False, True, True, True, False]


@pytest.mark.parametrize(
    ("given_input", "prompt"),
    [
        ("", "I"),
        (" \t\n", "I"),
        ("\u3000\u00a0\u001c", "I"),
        ("\u200b", "I\n\u200b"),
        (" x ", "I\n x "),
        (None, "I"),
    ],
)
def test_instruction_input(spark, given_input, prompt):
    df = spark.createDataFrame([("I", given_input, "O")], INSTRUCTION_INPUT)
    assert column(df, tx.render_instruction_input()) == [framed(prompt, "O")]


@pytest.mark.parametrize(
    ("system", "user", "prompt"),
    [
        ("S", "U", "S\nU"),
        ("S", None, "S"),
        ("S", "", "S"),
        ("S", " ", "S\n "),
        (None, "U", "\nU"),
        ("", "U", "\nU"),
        (None, None, ""),
    ],
)
def test_system_user(spark, system, user, prompt):
    df = spark.createDataFrame([(system, user, None)], SYSTEM_USER)
    assert column(df, tx.render_system_user()) == [framed(prompt, "")]


def test_prompt_response_null_policies(spark):
    df = spark.createDataFrame([(None, "R"), ("P", "")], PROMPT_RESPONSE)
    assert column(df, tx.render_prompt_response()) == [framed("", "R"), framed("P", "")]
    assert column(df, tx.render_prompt_response(null_policy="python")) == [
        framed(None, "R"),
        framed("P", ""),
    ]
    with pytest.raises(Exception, match="null in column prompt"):
        column(df, tx.render_prompt_response(null_policy="error"))
    with pytest.raises(ValueError):
        tx.render_prompt_response(null_policy="drop")


def test_null_input_fails_under_python_and_error(spark):
    df = spark.createDataFrame([("I", None, "O")], INSTRUCTION_INPUT)
    for policy in ("python", "error"):
        with pytest.raises(Exception, match="null in column input"):
            column(df, tx.render_instruction_input(null_policy=policy))


def test_null_instruction_renders_as_none_under_python(spark):
    df = spark.createDataFrame([(None, "x", None)], INSTRUCTION_INPUT)
    assert column(df, tx.render_instruction_input(null_policy="python")) == [framed("None\nx", "None")]


@SLOW
@given(st.lists(st.tuples(*[st.one_of(st.none(), st.text(st.characters(exclude_categories=["Cs"]), max_size=6))] * 3), min_size=1, max_size=20))
def test_rendering_matches_plain_python(spark, rows):
    system = spark.createDataFrame(rows, SYSTEM_USER)
    want = []
    for s, u, a in rows:
        s, u, a = s or "", u or "", a or ""
        want.append(framed(f"{s}\n{u}" if u else s, a))
    assert column(system, tx.render_system_user()) == want

    filled = [tuple(v or "" for v in r) for r in rows]
    instructions = spark.createDataFrame(filled, INSTRUCTION_INPUT)
    want = [framed(f"{i}\n{x}" if x.strip() else i, o) for i, x, o in filled]
    assert column(instructions, tx.render_instruction_input()) == want


def test_uri_parts(spark):
    df = spark.createDataFrame([("s3://bucket/k1/k2",), ("s3://bucket/k",), ("s3://bucket/",), ("s3://bucket",), ("x",)], "u string")
    got = [tuple(r) for r in df.select(tx.uri_bucket("u"), tx.uri_key("u")).collect()]
    assert got == [("bucket", "k1/k2"), ("bucket", "k"), ("bucket", ""), ("bucket", ""), (None, "")]


def test_timestamp_key(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 5, 7, 8, 9),)], "ts timestamp_ntz")
    assert column(df, tx.timestamp_key("ts")) == ["20240305-070809"]
    assert column(df, tx.timestamp_key("ts", "yyyyMMdd_HHmmss")) == ["20240305_070809"]
    assert len(column(df, tx.timestamp_key())[0]) == 15


def test_nfc(spark):
    texts = ["e\u0301", "\u1112\u1161\u11ab", "plain", "\U0001f600", "", None, "a\u0323\u0307"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert column(df, tx.nfc("t")) == [
        None if t is None else unicodedata.normalize("NFC", t) for t in texts
    ]


def test_broken_utf8_is_replaced(spark):
    df = spark.sql("SELECT cast(x'61FF62' AS string) AS t")
    assert column(df, tx.nfc("t")) == ["a\ufffdb"]


def test_a_batch_is_not_taken_as_strings_at_once():
    import tracemalloc

    import pyarrow as pa

    texts = pa.array(["é" + "word " * 800] * 2_000)
    tracemalloc.start()
    assert sum(map(len, tx.decoded(texts))) == 2_000 * 4_001
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1_000_000
    assert list(tx.decoded(pa.array(["a", None, ""]))) == ["a", None, ""]


def test_groups_of_texts():
    assert list(tx.grouped(["ab", None, "c", "", "defg", "h", None], 3)) == [["ab", None, "c"], ["", "defg"], ["h", None]]
    assert list(tx.grouped([], 3)) == []


def test_nfc_in_groups(spark, monkeypatch):
    monkeypatch.setattr(tx, "GROUP_CHARS", 3)
    df = spark.createDataFrame([(i, None if i % 5 == 0 else "e\u0301" * i) for i in range(20)], "i int, t string")
    got = {r["i"]: r["n"] for r in df.coalesce(1).select("i", tx.nfc("t").alias("n")).collect()}
    assert got == {i: None if i % 5 == 0 else "\u00e9" * i for i in range(20)}
