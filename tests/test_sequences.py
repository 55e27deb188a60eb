from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import sequences as seq
from corpusloom.operators.encode import encode, encode_pair
from corpusloom.operators.model_inputs import (
    assert_rectangular,
    close_sequences,
    pad_and_label,
    prepare,
    sequences,
)
from corpusloom.operators.stats import (
    count_examples,
    masked_length_stats,
    padded_length_stats,
    real_length_stats,
    stats_line,
)
from corpusloom.schemas import COMPAT_VOCAB, MODEL_INPUT, PROMPT_RESPONSE

VOCAB = {"a": 5, "b": 6, "c": 7}


@pytest.mark.parametrize(
    ("text", "ids", "mask", "labels"),
    [
        ("abc", [0, 0, 0, 0, 5, 6, 7, 0], [0] * 4 + [1] * 4, [-100] * 4 + [5, 6, 7, -100]),
        ("", [0] * 8, [0] * 7 + [1], [-100] * 8),
        ("aabbccaab", [5, 5, 6, 6, 7, 7, 5, 0], [1] * 8, [5, 5, 6, 6, 7, 7, 5, -100]),
        ("aZb", [0, 0, 0, 0, 5, 0, 6, 0], [0] * 4 + [1] * 4, [-100] * 4 + [5, -100, 6, -100]),
    ],
)
@pytest.mark.parametrize("form", ["arrow", "native"])
def test_model_inputs(spark, text, ids, mask, labels, form):
    df = spark.createDataFrame([(text,)], "text string")
    out = prepare(df, lambda: F.col("text"), VOCAB, max_length=8, form=form)
    row = assert_rectangular(out, 8).first()
    assert (row["input_ids"], row["attention_mask"], row["labels"]) == (ids, mask, labels)
    assert [f.name for f in out.schema] == [f.name for f in MODEL_INPUT]


def test_pair(spark):
    df = spark.createDataFrame([("a", "bc")], "first string, second string")
    assert encode_pair(df, VOCAB, "first", "second").first()["ids"] == [5, 0, 6, 7, 0]


def test_distinct_pad_id_keeps_eos_supervised(spark):
    df = spark.createDataFrame([([5, 0],)], "ids array<int>")
    row = pad_and_label(df, max_length=4, eos_id=0, pad_id=9).first()
    assert row["input_ids"] == [9, 9, 5, 0]
    assert row["labels"] == [-100, -100, 5, 0]
    assert seq.pad_id_or_eos(None, 3) == 3
    assert seq.pad_id_or_eos(9, 3) == 9


def test_columns_agree_with_each_other(spark):
    df = spark.createDataFrame([([],), ([1, 0, 2],), ([0],)], "ids array<int>")
    padded = seq.left_pad("ids", 5, 0)
    same = df.select(
        (seq.mask_labels(padded, 0) == seq.left_padded_labels("ids", 5, 0)).alias("labels"),
        (seq.real_length(seq.attention_mask("ids", 5)) == F.size("ids")).alias("length"),
        (seq.supervised_count("ids", 0) == F.size(F.filter("ids", lambda i: i != 0))).alias("count"),
    )
    assert all(all(r) for r in same.collect())


def test_truncate_leaves_room(spark):
    df = spark.createDataFrame([(list(range(1, 11)),)], "ids array<int>")
    assert close_sequences(df, max_length=4).first()["ids"] == [1, 2, 3, 0]
    assert df.select(seq.truncate("ids", 4, n_special=0).alias("x")).first()["x"] == [1, 2, 3, 4]


def test_wrong_length_fails(spark):
    df = spark.createDataFrame([([1], [1], [1])], "input_ids array<int>, attention_mask array<int>, labels array<int>")
    with pytest.raises(Exception, match="sequence length is not 8 but 1"):
        assert_rectangular(df, 8).collect()


def test_compat_vocab_supervises_only_im_start(spark):
    rows = [("hello", "you"), ("x" * 3000, "cut"), ("a<|im_start|>b<|endoftext|>c<|im_end|>", "d"), ("", "")]
    df = spark.createDataFrame(rows, PROMPT_RESPONSE)
    out = prepare(df, "prompt_response", COMPAT_VOCAB)
    supervised = [sum(x != -100 for x in r["labels"]) for r in out.collect()]
    assert supervised == [2, 1, 3, 2]
    assert out.count() == len(rows)


def test_preparing_does_not_shuffle(spark, plan_text):
    df = spark.createDataFrame([("a", "b")], PROMPT_RESPONSE)
    plan = plan_text(prepare(df, "prompt_response", COMPAT_VOCAB))
    assert "Exchange" not in plan
    assert plan.count("ArrowEvalPython [codegen") + plan.count("ArrowEvalPython (") >= 1


def test_statistics(spark):
    df = spark.createDataFrame([("a",), ("abc",), ("abcabcabc",)], "text string")
    closed = sequences(df, lambda: F.col("text"), VOCAB, max_length=8)
    real = real_length_stats(closed, max_length=8).first()
    assert real.asDict() == {
        "examples": 3,
        "min_length": 2,
        "max_length": 8,
        "avg_length": 14 / 3,
        "truncated": 1,
        "supervised": 11,
    }
    inputs = pad_and_label(closed, max_length=8)
    padded = padded_length_stats(inputs).first()
    assert (padded["min_length"], padded["max_length"], padded["avg_length"]) == (8, 8, 8.0)
    masked = masked_length_stats(inputs).first()
    assert (masked["min_length"], masked["max_length"], masked["avg_length"]) == (2, 8, 14 / 3)
    assert count_examples(inputs).first()["examples"] == 3
    assert stats_line(real).endswith("min 2, max 8, avg 4.67")


def test_statistics_of_nothing(spark):
    df = spark.createDataFrame([], "input_ids array<int>, attention_mask array<int>")
    row = padded_length_stats(df).first()
    assert (row["examples"], row["min_length"]) == (0, None)
    assert stats_line(row) == "Total examples: 0"


def test_mean_is_rounded_from_its_binary_value(spark):
    assert stats_line({"examples": 1, "min_length": 2, "max_length": 3, "avg_length": 2.675}).endswith("2.67")


def test_total_row(spark):
    df = spark.createDataFrame([("x", "a"), ("y", "abc")], "lang string, text string")
    closed = sequences(df, lambda: F.col("text"), VOCAB, max_length=8, keep=["lang"])
    got = real_length_stats(closed, max_length=8, by=["lang"], with_total=True)
    assert {r["lang"]: r["examples"] for r in got.collect()} == {"x": 1, "y": 1, None: 2}


def test_encode_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, "ab")], "id int, text string")
    assert encode(df, VOCAB, count_col="n").columns == ["id", "text", "ids", "n"]
