"""A responder is called once for each case, whatever stops the job in between."""

from __future__ import annotations

import json
import uuid
from collections import Counter

import pytest

from corpusloom.streaming.responses import read_journal, start_responses


def case_file(folder, name: str, cases: range, broken: bool = False) -> None:
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"test_case": c, "part": p, "messages": [{"role": "user", "content": f"case {c} part {p}"}]}) for c in cases for p in range(1 + c % 2)]
    (folder / name).write_text("\n".join(lines + ['{"test_case": '] * broken) + "\n")


@pytest.fixture
def responder(tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    at = str(calls)

    def respond(messages):
        case = messages[0]["content"].split()[1]
        with open(f"{at}/{uuid.uuid4().hex}", "w") as f:
            f.write(case)
        if case == "7":
            raise RuntimeError("seven")
        return f"{len(messages)} of {case}"

    return respond, lambda: Counter(int(f.read_text()) for f in calls.iterdir())


def answers(spark, journal) -> dict:
    return {r["test_case"]: (r["response"], r["error"]) for r in read_journal(spark, journal).collect()}


def want(cases) -> dict:
    return {c: (None, "RuntimeError: seven") if c == 7 else (f"{1 + c % 2} of {c}", None) for c in cases}


def test_a_stopped_job_goes_on_where_it_was(spark, tmp_path, responder):
    respond, calls = responder
    cases, journal, checkpoint = tmp_path / "cases", str(tmp_path / "journal"), str(tmp_path / "checkpoint")
    assert answers(spark, journal) == {}
    for k in range(4):
        case_file(cases, f"{k}.json", range(5 * k, 5 * k + 5), broken=k == 2)
    with pytest.raises(Exception):
        start_responses(spark, str(cases), journal, checkpoint, respond, partitions=2).awaitTermination()
    before = answers(spark, journal)
    assert before == want(before) and 0 < len(before) < 20
    case_file(cases, "2.json", range(10, 15))
    start_responses(spark, str(cases), journal, checkpoint, respond, partitions=2).awaitTermination()
    assert answers(spark, journal) == want(range(20))
    # Only the batch that failed may have called for a case before.
    assert set(calls()) == set(range(20)) and all(n == 1 for c, n in calls().items() if c not in range(10, 15))

    # Without the checkpoint all files are read again, and nothing is called again.
    seen = calls()
    case_file(cases, "9.json", range(18, 23))
    start_responses(spark, str(cases), journal, str(tmp_path / "other"), respond).awaitTermination()
    assert answers(spark, journal) == want(range(23))
    assert calls() - seen == Counter([20, 21, 22])

    # Failed cases are tried again if asked for.
    seen = calls()
    start_responses(spark, str(cases), journal, str(tmp_path / "third"), lambda m: "now", retry_errors=True).awaitTermination()
    assert answers(spark, journal) == want(range(23)) | {7: ("now", None)}
    assert calls() == seen


def test_a_batch_that_was_written_is_not_answered_again(spark, tmp_path, responder):
    """As if the job had died after the journal and before the stream's own note of it."""
    respond, calls = responder
    cases, journal, checkpoint = tmp_path / "cases", str(tmp_path / "journal"), tmp_path / "checkpoint"
    case_file(cases, "0.json", range(4))
    start_responses(spark, str(cases), journal, str(checkpoint), respond).awaitTermination()
    for note in (checkpoint / "stream" / "commits").iterdir():
        note.unlink()
    start_responses(spark, str(cases), journal, str(checkpoint), respond).awaitTermination()
    assert calls() == Counter(range(4))
    assert answers(spark, journal) == want(range(4))
