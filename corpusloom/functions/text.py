"""String predicates, chat templates, URI parts, time-stamp keys, NFC."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.schemas import IM_END, IM_START

# Fixed value: the 29 code points a Unicode-aware strip() removes, as a regex class body.
UNICODE_SPACE = (
    r"\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)

# Characters of a batch that a task has as Python strings at a time. A row is never cut, so one may be longer.
GROUP_CHARS = 1 << 20

NULL_POLICIES = ("empty", "python", "error")

# The frame around every rendered example.
FRAME_HEAD = f"{IM_START}user\n"
FRAME_MIDDLE = f"{IM_END}\n{IM_START}assistant\n"
FRAME_TAIL = IM_END


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: Column | str) -> Column:
    """True when nothing but Unicode white space is left; the regex stops at the first other character."""
    return ~F.rlike(_col(c), F.lit(f"[^{UNICODE_SPACE}]"))


def is_non_empty(c: Column | str) -> Column:
    """Plain truthiness of a string: null and '' are false, white space is true."""
    return F.coalesce(_col(c), F.lit("")) != ""


def null_to_empty(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(""))


def with_null_policy(c: Column | str, policy: str, what: str = "text") -> Column:
    """'empty': null renders as ''. 'python': as the word None. 'error': the job fails."""
    if policy not in NULL_POLICIES:
        raise ValueError(f"null_policy must be one of {NULL_POLICIES}, not {policy!r}")
    if policy == "empty":
        return null_to_empty(c)
    if policy == "python":
        return F.coalesce(_col(c), F.lit("None"))
    return F.coalesce(_col(c), F.raise_error(F.lit(f"null in column {what}")).cast("string"))


def chat_frame(prompt: Column, answer: Column) -> Column:
    """One user turn and one assistant turn in the chat mark-up."""
    return F.concat(F.lit(FRAME_HEAD), prompt, F.lit(FRAME_MIDDLE), answer, F.lit(FRAME_TAIL))


def render_prompt_response(
    prompt: Column | str = "prompt", response: Column | str = "response", null_policy: str = "empty"
) -> Column:
    return chat_frame(
        with_null_policy(prompt, null_policy, "prompt"),
        with_null_policy(response, null_policy, "response"),
    )


def render_instruction_input(
    instruction: Column | str = "instruction",
    input: Column | str = "input",
    output: Column | str = "output",
    null_policy: str = "empty",
) -> Column:
    """A blank input is left out; any other input is appended as it stands, not stripped.

    Under 'python' a null input fails the job (None has no strip()), the other two columns
    render as None.
    """
    instruction_text = with_null_policy(instruction, null_policy, "instruction")
    input_text = with_null_policy(input, "error" if null_policy == "python" else null_policy, "input")
    prompt = F.when(is_blank(input_text), instruction_text).otherwise(
        F.concat(instruction_text, F.lit("\n"), input_text)
    )
    return chat_frame(prompt, with_null_policy(output, null_policy, "output"))


def render_system_user(
    system_prompt: Column | str = "system_prompt",
    user_prompt: Column | str = "user_prompt",
    answer: Column | str = "answer",
    null_policy: str = "empty",
) -> Column:
    """Nulls become '' (also under 'python'). An empty system prompt leaves its newline behind."""
    policy = "error" if null_policy == "error" else "empty"
    system_text = with_null_policy(system_prompt, policy, "system_prompt")
    user_text = with_null_policy(user_prompt, policy, "user_prompt")
    prompt = F.when(user_text != "", F.concat(system_text, F.lit("\n"), user_text)).otherwise(system_text)
    return chat_frame(prompt, with_null_policy(answer, policy, "answer"))


TEMPLATES = {
    "prompt_response": render_prompt_response,
    "instruction_input": render_instruction_input,
    "system_user": render_system_user,
}


def uri_bucket(uri: Column | str) -> Column:
    """Third '/'-separated part of an object URI; null when there is none."""
    return F.get(F.split(_col(uri), "/"), F.lit(2))


def uri_key(uri: Column | str) -> Column:
    """Everything after the bucket, '' when the URI ends there."""
    parts = F.split(_col(uri), "/")
    return F.array_join(F.slice(parts, F.lit(4), F.size(parts)), "/")


def timestamp_key(ts: Column | str | None = None, pattern: str = "yyyyMMdd-HHmmss") -> Column:
    """Time stamp as a path part; now when no column is given."""
    return F.date_format(F.current_timestamp() if ts is None else _col(ts), pattern)


def decoded(texts: pa.Array) -> Iterator[str | None]:
    """Python strings of an Arrow string column, one at a time; broken UTF-8 is replaced instead of raising."""
    for scalar in texts.cast(pa.binary()):
        raw = scalar.as_py()
        yield None if raw is None else raw.decode("utf-8", "replace")


def grouped(texts: Iterable[str | None], size: int) -> Iterator[list[str | None]]:
    """The texts one after the other in groups of about `size` characters."""
    group: list[str | None] = []
    n = 0
    for text in texts:
        group.append(text)
        n += len(text or "")
        if n >= size:
            yield group
            group, n = [], 0
    if group:
        yield group


def nfc(c: Column | str) -> Column:
    """Canonical composition. Spark has no built-in for it, so this is an Arrow UDF."""

    @F.arrow_udf("string")
    def compose(texts: pa.Array) -> pa.Array:
        composed = [
            pa.array([None if t is None else unicodedata.normalize("NFC", t) for t in group], pa.string())
            for group in grouped(decoded(texts), GROUP_CHARS)
        ]
        return pa.concat_arrays(composed) if composed else pa.array([], pa.string())

    return compose(_col(c))
