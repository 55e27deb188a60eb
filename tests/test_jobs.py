"""Sources, sinks, responses, batches and metric extraction."""

from __future__ import annotations

import json
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.metrics import COMPAT_METRICS, FLOAT_METRICS
from corpusloom.operators.batches import map_batches
from corpusloom.operators.responses import as_results, batch_responses, case_inputs, count_cases
from corpusloom.queries import q_case_array_files
from corpusloom.schemas import CASE, MODEL_INPUT, RESULT
from corpusloom.sinks.scratch import scratch_path, scratch_root
from corpusloom.sinks.writers import (
    message_key,
    write_cases,
    write_corpus,
    write_model_inputs,
    write_results,
    write_summary,
)
from corpusloom.sources.cases import SMOKE_CONVERSATIONS, inline_cases, read_cases
from corpusloom.sources.corpora import CSV_NULL, corpus_columns, read_corpus, select_split
from corpusloom.sources.logs import read_logs
from corpusloom.streaming.loss_metrics import extract_metrics, start_metric_stream


def lines_of(path) -> list[str]:
    return [line for f in sorted(Path(path).glob("part-*")) for line in f.read_text("utf-8").splitlines()]


@pytest.mark.parametrize("format", ["parquet", "json", "csv", "orc"])
def test_corpus_splits(spark, tmp_path, format, plan_text):
    path = str(tmp_path / "corpus")
    rows = [("a\nb", 'say "hi", x', "train"), ("c", "d", "test"), ("한글", "\\", "train")]
    write_corpus(spark.createDataFrame(rows, "prompt string, response string, split string"), path, format)
    whole = read_corpus(spark, path, "prompt_response", format)
    assert sorted(tuple(r) for r in whole.collect()) == sorted(rows)
    assert corpus_columns(whole) == ["prompt", "response"]
    train = read_corpus(spark, path, "prompt_response", format, split="train")
    assert sorted(tuple(r) for r in train.collect()) == sorted(r[:2] for r in rows if r[2] == "train")
    if format == "csv":  # read range by range, before the plan that is returned
        (tmp_path / "corpus" / "split=test" / "broken.csv").write_text('prompt,response\n"not closed\n')
        again = read_corpus(spark, path, "prompt_response", format, split="train")
        assert sorted(again.collect()) == sorted(train.collect())
        return
    partition_filter = [x for x in plan_text(train).splitlines() if x.startswith("PartitionFilters")]
    assert partition_filter and "train" in partition_filter[0]


TEXTS = ["  lead", "trail  ", "   ", "", None, 'say "hi"', '"', "a\nb\r\nc", ",", "\\N", "\\", "null", "\u3000", "# x", " \t", "한글"]


@pytest.mark.parametrize("format", ["parquet", "json", "csv"])
def test_texts_come_back_as_they_were(spark, tmp_path, format):
    path = str(tmp_path / "corpus")
    rows = [(f"{i}", t, t, "train") for i, t in enumerate(TEXTS)]
    schema = "instruction string, input string, output string, split string"
    write_corpus(spark.createDataFrame(rows, schema), path, format)
    back = read_corpus(spark, path, "instruction_input", format)
    assert sorted((tuple(r) for r in back.collect()), key=str) == sorted(rows, key=str)


@pytest.mark.parametrize("line", ['"a"', '"a","b","c"'])
def test_broken_csv_rows_fail(spark, tmp_path, line):
    (tmp_path / "corpus.csv").write_text(f'"prompt","response"\n"x","y"\n{line}\n')
    with pytest.raises(Exception):
        read_corpus(spark, str(tmp_path), "prompt_response", "csv").collect()


def test_a_text_like_the_csv_null_fails(spark, tmp_path):
    df = spark.createDataFrame([(CSV_NULL, "x", "train")], "prompt string, response string, split string")
    with pytest.raises(Exception, match="mark of a null"):
        write_corpus(df, str(tmp_path / "corpus"), "csv")


@pytest.mark.parametrize("format", ["parquet", "json", "csv"])
def test_corpus_without_split_directories(spark, tmp_path, format):
    path = str(tmp_path / "flat")
    df = spark.createDataFrame([("i", "x", "o")], "instruction string, input string, output string")
    df.write.option("header", "true").format(format).save(path)
    got = read_corpus(spark, path, "instruction_input", format)
    assert [tuple(r) for r in got.collect()] == [("i", "x", "o", "train")]
    assert select_split(got).columns == ["instruction", "input", "output"]
    assert select_split(got, "test").count() == 0
    with pytest.raises(ValueError):
        read_corpus(spark, path, "instruction_input", "xml")


def test_splits_by_file_name(spark, tmp_path, plan_text):
    for name, text in (("train-0", "a"), ("test-0", "b"), ("validation", "c"), ("trainees", "d"), ("other", "e")):
        (tmp_path / f"{name}.json").write_text(json.dumps({"prompt": text, "response": "r"}) + "\n")
    whole = read_corpus(spark, str(tmp_path), "prompt_response", "json", splits="file")
    got = {r["prompt"]: r["split"] for r in whole.collect()}
    assert got == {"a": "train", "b": "test", "c": "validation", "d": "train", "e": "train"}
    test = read_corpus(spark, str(tmp_path), "prompt_response", "json", splits="file", split="test")
    assert [tuple(r) for r in test.collect()] == [("b", "r")]
    with pytest.raises(ValueError):
        read_corpus(spark, str(tmp_path), "prompt_response", "json", splits="column")


def test_broken_json_lines_fail(spark, tmp_path):
    (tmp_path / "train.json").write_text('{"prompt": \n')
    with pytest.raises(Exception):
        read_corpus(spark, str(tmp_path), "prompt_response", "json").collect()
    with pytest.raises(Exception):
        read_cases(spark, str(tmp_path)).collect()


def test_json_array_cases(spark, tmp_path):
    suite = [*SMOKE_CONVERSATIONS, [], [{"role": "assistant", "content": 'q"\n'}]]
    file = tmp_path / "cases.json"
    file.write_text(json.dumps(suite, ensure_ascii=False, indent=2), "utf-8")
    cases = read_cases(spark, str(file), "array")
    got = sorted(cases.collect(), key=lambda r: r["test_case"])
    assert [r["test_case"] for r in got] == [1, 2, 3, 4, 5]
    assert [[m.asDict() for m in r["messages"]] for r in got] == suite
    inputs = {r["test_case"]: r["input"] for r in case_inputs(cases).collect()}
    assert inputs == {1: suite[0][1]["content"], 2: suite[1][1]["content"], 3: suite[2][1]["content"], 4: None, 5: 'q"\n'}
    assert count_cases(cases).first()["cases"] == 5
    with pytest.raises(ValueError):
        read_cases(spark, str(file), "xml")


def test_array_files_are_numbered_together(spark, tmp_path):
    talks = [[{"role": "user", "content": c}] for c in "abcd"]
    (tmp_path / "2.json").write_text(json.dumps(talks[2:]))
    (tmp_path / "1.json").write_text(json.dumps(talks[:2]))
    got = {r["test_case"]: r["messages"][0]["content"] for r in read_cases(spark, str(tmp_path), "array").collect()}
    assert got == {1: "a", 2: "b", 3: "c", 4: "d"}


def test_broken_json_array_fails(spark, tmp_path):
    file = tmp_path / "cases.json"
    file.write_text('[[{"role": ', "utf-8")
    with pytest.raises(Exception):
        read_cases(spark, str(file), "array").collect()


def test_cases_written_under_a_time_stamp(spark, tmp_path):
    at = datetime(2024, 3, 5, 7, 8, 9)
    cases = inline_cases(spark)
    path = write_cases(cases, str(tmp_path), at)
    assert path == message_key(str(tmp_path) + "/", at) == f"{tmp_path}/20240305-070809/test_messages.json"
    back = read_cases(spark, path)
    assert {r["part"] for r in back.collect()} == {0}
    assert sorted(map(str, back.drop("part").collect())) == sorted(map(str, cases.collect()))
    assert SMOKE_CONVERSATIONS[0][1]["content"] in "".join(lines_of(path))


def test_responses_survive_failures(spark, tmp_path):
    def respond(messages):
        if "poem" in messages[-1]["content"]:
            raise RuntimeError("no poems")
        return f"{messages[0]['role']}: {messages[-1]['content']}"

    responses = batch_responses(inline_cases(spark), respond, partitions=2)
    got = {r["test_case"]: r for r in responses.collect()}
    assert got[2]["response"] == "system: 사과는 무슨 색인가요?"
    assert (got[3]["response"], got[3]["error"]) == (None, "RuntimeError: no poems")
    assert got[1]["error"] is None

    path = str(tmp_path / "results")
    write_results(responses, path)
    written = [json.loads(line) for line in lines_of(path)]
    assert [w["test_case"] for w in written] == [1, 2, 3]
    assert list(written[2]) == ["test_case", "input", "response"] and written[2]["response"] is None
    assert got[1]["input"] in lines_of(path)[0]
    assert spark.read.schema(RESULT).json(path).count() == 3
    assert as_results(responses).columns == RESULT.fieldNames()


def test_each_case_is_answered_once(spark, tmp_path):
    calls = str(tmp_path / "calls")

    def respond(messages):
        with open(calls, "a") as f:
            f.write("x\n")
        return messages[-1]["content"]

    cases = spark.range(1, 101).selectExpr("CAST(id AS INT) AS test_case", "array(struct('user' AS role, string(id) AS content)) AS messages")
    write_results(batch_responses(cases.repartition(4), respond), str(tmp_path / "results"))
    assert len(Path(calls).read_text().splitlines()) == 100
    written = [json.loads(line)["test_case"] for line in lines_of(tmp_path / "results")]
    assert written == list(range(1, 101))


def test_responder_is_set_up_in_the_task(spark):
    def load():
        seen = []

        def respond(messages):
            seen.append(1)
            return None if not messages else f"{len(seen)}"

        return respond

    cases = spark.createDataFrame([(1, [("user", "a")]), (2, []), (3, None)], CASE).coalesce(1)
    got = {r["test_case"]: r["response"] for r in batch_responses(cases, setup=load).collect()}
    assert got == {1: "1", 2: None, 3: None}
    with pytest.raises(ValueError):
        batch_responses(cases)


def test_batches_of_cases_keep_errors_apart(spark):
    sizes = []

    def respond(talks):
        sizes.append(len(talks))
        if any(m and m[-1]["content"] == "crash" for m in talks):
            raise RuntimeError("whole batch")
        return [ValueError("empty") if not m else m[-1]["content"].upper() for m in talks]

    rows = [(1, [("user", "a")]), (2, []), (3, [("user", "b")]), (4, [("user", "crash")]), (5, None)]
    cases = spark.createDataFrame(rows, CASE).coalesce(1)
    got = {r["test_case"]: (r["response"], r["error"]) for r in batch_responses(cases, respond, batch_size=2).collect()}
    assert got == {
        1: ("A", None),
        2: (None, "ValueError: empty"),
        3: ("B", None),
        4: (None, "RuntimeError: whole batch"),
        5: (None, "ValueError: empty"),
    }


def test_failing_setup_fails_the_job(spark):
    def load():
        raise RuntimeError("no model")

    with pytest.raises(Exception, match="no model"):
        batch_responses(inline_cases(spark), setup=load).collect()


def test_map_batches(spark, plan_text):
    df = spark.createDataFrame([(1, "a", None, "u"), (2**60, "bb", 3, "v")], "id long, t string, n int, unused string")
    got = map_batches(
        df,
        lambda b: {"size": [len(t) for t in b["t"]], "ids": [[n] if n else None for n in b["n"]]},
        "size int, ids array<int>",
        keep=["id"],
        columns=["t", "n"],
    )
    assert sorted(tuple(r) for r in got.collect()) == [(1, 1, None), (2**60, 2, [3])]
    everything = map_batches(df, lambda b: {"k": [sorted(b)] * len(b["id"])}, "k array<string>", partitions=2)
    assert everything.first()["k"] == ["id", "n", "t", "unused"]
    with pytest.raises(Exception, match="1 values of x for 2 rows"):
        map_batches(df.coalesce(1), lambda b: {"x": [1]}, "x int").collect()


LOG = [
    ("train_loss: 1.25 step", [("train:loss", 1.25)], [("train:loss", 1.25)]),
    ("eval_loss: 0.5", [("eval:loss", 0.5)], [("eval:loss", 0.5)]),
    ("train_loss: 2e-05", [("train:loss", 2.0)], [("train:loss", 2e-05)]),
    ("train_loss: nan", [], []),
    ("train_loss: 1.2.3", [("train:loss", None)], [("train:loss", 1.2)]),
    ("{'train_loss': 1.7}", [], [("train:loss", 1.7)]),
    ("train_loss: -3", [], [("train:loss", -3.0)]),
    ("train_loss: 1 eval_loss: 2", [("train:loss", 1.0), ("eval:loss", 2.0)], [("train:loss", 1.0), ("eval:loss", 2.0)]),
    ("nothing", [], []),
    ("", [], []),
]


@pytest.mark.parametrize(("definitions", "which"), [(COMPAT_METRICS, 1), (FLOAT_METRICS, 2)])
def test_metric_patterns(spark, definitions, which):
    df = spark.createDataFrame([(row[0],) for row in LOG], "value string")
    got = [tuple(r) for r in extract_metrics(df, definitions, keep=["value"]).collect()]
    assert got == [(row[0], *m) for row in LOG for m in row[which]]


def test_stream_equals_batch_and_continues(spark, tmp_path):
    logs, out, checkpoint = (str(tmp_path / d) for d in ("logs", "out", "checkpoint"))
    for i in range(2):
        spark.createDataFrame([(row[0],) for row in LOG], "value string").coalesce(1).write.mode("append").text(logs)
        start_metric_stream(spark, logs, out, checkpoint, max_files_per_trigger=1).awaitTermination()
        batch = extract_metrics(read_logs(spark, logs), keep=["value"])
        streamed = spark.read.parquet(out).select("line", "metric", "value")
        assert sorted(map(str, map(tuple, streamed.collect()))) == sorted(map(str, map(tuple, batch.collect())))
        assert streamed.count() == 6 * (i + 1)


def test_running_stream_can_be_stopped(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "a.log").write_text("train_loss: 3.5\n")
    query = start_metric_stream(spark, str(logs), str(tmp_path / "out"), str(tmp_path / "ck"), interval="1 second")
    query.processAllAvailable()
    query.stop()
    assert [r["value"] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [3.5]


def test_summary_and_model_inputs(spark, tmp_path):
    write_summary(spark, {"train_loss": 1.5, "steps": 3}, str(tmp_path / "summary"))
    assert [json.loads(x) for x in lines_of(tmp_path / "summary")] == [{"steps": 3, "train_loss": 1.5}]
    df = spark.createDataFrame([([1], [1], [1])], MODEL_INPUT).withColumn("split", F.lit("train"))
    write_model_inputs(df, str(tmp_path / "inputs"), partition_by=["split"], partitions=1)
    assert (tmp_path / "inputs" / "split=train").is_dir()


def test_scratch_folder_comes_from_the_session(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch_root(spark) == (before.rstrip("/") if before else scratch_root(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_case_array_files_follow_the_rows(spark, tmp_path):
    ids = range(4000)
    spark.createDataFrame([(i, f"text {i}") for i in ids], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    cases = q_case_array_files(spark, str(tmp_path))
    assert len(cases.inputFiles()) >= 4
    want = [(n + 1, 2, f"text {i}", f"item {i}") for n, i in enumerate(sorted(ids, key=lambda i: (i % 2, i)))]
    assert sorted(map(tuple, cases.collect())) == want
