"""Run a table of conversations through a user function."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Messages = list[dict[str, str]]
Responder = Callable[[Messages], str | None]
BatchResponder = Callable[[list[Messages]], list[str | None | Exception]]


def last_content(messages: Column | str = "messages") -> Column:
    """Content of the last message, whatever its role; null for an empty conversation."""
    c = F.col(messages) if isinstance(messages, str) else messages
    return F.try_element_at(c, F.lit(-1))["content"]


def case_inputs(cases: DataFrame) -> DataFrame:
    """(test_case, input): the last message of the whole case, of its last part if it has several."""
    if "part" not in cases.columns:
        return cases.select("test_case", last_content().alias("input"))
    last = F.max_by(F.struct(last_content().alias("input")), "part")
    return cases.groupBy("test_case").agg(last.alias("last")).select("test_case", "last.input")


def count_cases(cases: DataFrame) -> DataFrame:
    return cases.select("test_case").distinct().agg(F.count("*").alias("cases"))


def _whole_cases(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Messages]]:
    """Cases with all their messages, from parts that follow each other."""
    case, messages = None, []
    for batch in batches:
        for test_case, part in zip(batch.column("test_case").to_pylist(), batch.column("messages").to_pylist()):
            if case is not None and test_case != case[0]:
                yield case[0], messages
                messages = []
            case = (test_case,)
            messages = messages + [{"role": m["role"], "content": m["content"]} for m in part or ()]
    if case is not None:
        yield case[0], messages


def _answer(respond: Responder, messages: Messages) -> tuple[str | None, str | None]:
    try:
        return respond(messages), None
    except Exception as e:
        return None, f"{type(e).__name__}: {e}"


def _answers(respond: BatchResponder, batch: list[Messages]) -> list[tuple[str | None, str | None]]:
    """Answers of one call for all; if that fails, of one call for each, so that an error stays with its case."""
    try:
        found = list(respond(batch))
        if len(found) != len(batch):
            raise ValueError(f"{len(found)} answers for {len(batch)} cases")
        return [(None, f"{type(x).__name__}: {x}") if isinstance(x, Exception) else (x, None) for x in found]
    except Exception as e:
        if len(batch) == 1:
            return [(None, f"{type(e).__name__}: {e}")]
        return [a for messages in batch for a in _answers(respond, [messages])]


def batch_responses(
    cases: DataFrame,
    responder: Responder | BatchResponder | None = None,
    *,
    setup: Callable[[], Responder | BatchResponder] | None = None,
    partitions: int | None = None,
    batch_size: int | None = None,
) -> DataFrame:
    """(test_case, input, response, error) for cases of (test_case, messages) or (test_case, part, messages).

    The responder gets a list of role and content dicts, once for each whole case: the parts of a
    case come to one task and are put together there. With `batch_size` it gets a list of up to so
    many cases and returns as many answers, an exception object standing for a failed one. If it
    raises, the response is null, the error text is kept and the job goes on; a batch that fails is
    tried case by case. `setup` builds the responder once per task, for functions that load a
    model; an error in setup fails the job.
    """
    if (responder is None) == (setup is None):
        raise ValueError("give either responder or setup")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        respond = responder if responder is not None else setup()
        held: list[tuple[int, Messages]] = []

        def rows() -> pa.RecordBatch:
            talks = [messages for _, messages in held]
            found = [_answer(respond, talks[0])] if batch_size is None else _answers(respond, talks)
            return pa.RecordBatch.from_pydict(
                {
                    "test_case": pa.array([case for case, _ in held], pa.int32()),
                    "input": pa.array([m[-1]["content"] if m else None for m in talks], pa.string()),
                    "response": pa.array([a for a, _ in found], pa.string()),
                    "error": pa.array([e for _, e in found], pa.string()),
                }
            )

        for case in _whole_cases(batches):
            held.append(case)
            if len(held) >= (batch_size or 1):
                yield rows()
                held = []
        if held:
            yield rows()

    if "part" in cases.columns:
        by_case = [F.col("test_case")] if partitions is None else [partitions, F.col("test_case")]
        cases = cases.repartition(*by_case).sortWithinPartitions("test_case", "part")
    elif partitions is not None:
        cases = cases.repartition(partitions)
    return cases.select("test_case", "messages").mapInArrow(
        run, "test_case int, input string, response string, error string"
    )


def as_results(responses: DataFrame) -> DataFrame:
    """The three columns a result file holds."""
    return responses.select("test_case", "input", "response")
