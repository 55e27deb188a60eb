"""Records of files that Spark cuts into many ranges, against parsers that read a file as one."""

from __future__ import annotations

import csv
import io
import json
import random

import pytest

from corpusloom.sources.cases import read_cases
from corpusloom.sources.corpora import read_corpus
from corpusloom.sources.ranges import CSV, json_elements, numbered, read_records

TEXTS = ["", " ", "plain", "a,b", 'say "hi"', "two\nlines", "\n\n", '"', '""', '",\n"', "é ü 😀", "end\\", '\\"', "x" * 150, "[1]", "]", "}{", "\t"]


@pytest.fixture(params=[90, 1 << 20])
def ranges(spark, request):
    """Files are cut into ranges of so many bytes."""
    settings = {"spark.sql.files.maxPartitionBytes": request.param, "spark.sql.files.openCostInBytes": 1, "spark.sql.files.minPartitionNum": 1}
    for key, value in settings.items():
        spark.conf.set(key, str(value))
    yield request.param
    for key in settings:
        spark.conf.unset(key)


def csv_file(path, rows, end="\n", header=("prompt", "response")):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end, quoting=csv.QUOTE_MINIMAL)
    writer.writerow(header)
    writer.writerows(rows)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(out.getvalue().encode())


def some_rows(n: int, seed: int) -> list[tuple[str, str]]:
    rng = random.Random(seed)
    return [(f"{i} {rng.choice(TEXTS)}", rng.choice(TEXTS[2:])) for i in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_equals_a_parser_of_whole_files(spark, tmp_path, ranges, end):
    rows = some_rows(40, ranges)
    csv_file(tmp_path / "a.csv", rows[:30], end)
    csv_file(tmp_path / "b.csv", rows[30:], end)
    got = read_corpus(spark, str(tmp_path), "prompt_response", "csv", nullValue="").select("prompt", "response").collect()
    assert sorted((r["prompt"], r["response"]) for r in got) == sorted((a, b) for a, b in rows)


def test_csv_file_is_many_tasks(spark, tmp_path, ranges):
    csv_file(tmp_path / "a.csv", some_rows(40, 1))
    found = read_records(spark, str(tmp_path), CSV)
    size = (tmp_path / "a.csv").stat().st_size
    starts = {r["start"] for r in found.select("start").collect()}
    assert len(starts) > 1 or ranges > size
    if ranges == 90:
        assert len(starts) > 5


def test_csv_splits_and_files(spark, tmp_path, ranges):
    rows = some_rows(30, 2)
    csv_file(tmp_path / "d" / "split=train" / "x.csv", rows[:20])
    csv_file(tmp_path / "d" / "split=test" / "x.csv", rows[20:])
    got = read_corpus(spark, str(tmp_path / "d"), "prompt_response", "csv", split="test", nullValue="")
    assert got.columns == ["prompt", "response"]
    assert sorted(map(tuple, got.collect())) == sorted(rows[20:])
    csv_file(tmp_path / "f" / "test-0.csv", rows[:9])
    csv_file(tmp_path / "f" / "more.csv", rows[9:])
    got = read_corpus(spark, str(tmp_path / "f"), "prompt_response", "csv", splits="file", nullValue="")
    counts = {r["split"]: r["count"] for r in got.groupBy("split").count().collect()}
    assert counts == {"test": 9, "train": 21}


def test_csv_record_longer_than_many_ranges(spark, tmp_path, ranges):
    rows = [("first", "x\n" * 150), ("second", "y"), ("third", '"\n' * 100)]
    csv_file(tmp_path / "a.csv", rows)
    got = read_corpus(spark, str(tmp_path), "prompt_response", "csv").select("prompt", "response").collect()
    assert sorted(map(tuple, got)) == rows


def test_csv_that_is_not_closed_fails(spark, tmp_path, ranges):
    (tmp_path / "a.csv").write_text('prompt,response\na,b\nc,"d\ne,f\n')
    with pytest.raises(Exception, match="not closed"):
        read_corpus(spark, str(tmp_path), "prompt_response", "csv").collect()


def test_csv_with_a_field_too_many_fails(spark, tmp_path, ranges):
    (tmp_path / "a.csv").write_text("prompt,response\na,b\nc,d,e\n")
    with pytest.raises(Exception):
        read_corpus(spark, str(tmp_path), "prompt_response", "csv").collect()


def test_empty_csv_files(spark, tmp_path, ranges):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text("prompt,response\n")
    (tmp_path / "c.csv").write_text("prompt,response\n\n\nx,y")
    got = read_corpus(spark, str(tmp_path), "prompt_response", "csv").select("prompt", "response").collect()
    assert [tuple(r) for r in got] == [("x", "y")]


def suites(n: int, seed: int) -> list[list[dict[str, str]]]:
    rng = random.Random(seed)
    return [[{"role": rng.choice(["user", "system"]), "content": rng.choice(TEXTS)} for _ in range(rng.randrange(4))] for _ in range(n)]


@pytest.mark.parametrize("form", [{}, {"indent": 1}, {"ensure_ascii": False, "separators": (",", ":")}])
def test_json_arrays_keep_their_order(spark, tmp_path, ranges, form):
    talks = suites(25, ranges)
    parts = [talks[:1], talks[1:20], [], talks[20:]]
    for i, part in enumerate(parts):
        (tmp_path / f"{i}.json").write_text(json.dumps(part, **form) + "\n" * (i % 2))
    cases = read_cases(spark, str(tmp_path), "array").collect()
    got = [[m.asDict() for m in r["messages"]] for r in sorted(cases)]
    assert [r["test_case"] for r in sorted(cases)] == list(range(1, 26))
    assert got == talks


def test_json_objects(spark, tmp_path, ranges):
    rng = random.Random(4)
    made = [{"case": i, "text": rng.choice(TEXTS), "inner": {"list": ["}", {}]}} for i in range(20)]
    (tmp_path / "a.json").write_text(json.dumps(made[:15]))
    (tmp_path / "b.json").write_text("﻿" + json.dumps(made[15:], indent=2) + "\n")
    found = numbered(json_elements(spark, str(tmp_path), objects=True), "n").collect()
    assert [json.loads(r["value"]) for r in sorted(found, key=lambda r: r["n"])] == made


def test_json_array_that_is_not_closed_fails(spark, tmp_path, ranges):
    (tmp_path / "a.json").write_text('[[{"role": "user", "content": "a"}], [{"role": "user"')
    with pytest.raises(Exception):  # of what is left, or of its JSON
        read_cases(spark, str(tmp_path), "array").collect()
