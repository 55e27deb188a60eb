"""Rendered text to model inputs: ids, attention mask and labels of one fixed length."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame

from corpusloom.functions.sequences import (
    append_eos,
    attention_mask,
    left_pad,
    left_padded_labels,
    pad_id_or_eos,
    rectangular,
    truncate,
)
from corpusloom.functions.text import TEMPLATES
from corpusloom.operators.encode import encode, encode_with
from corpusloom.schemas import DECLARED_SPECIALS, DEFAULT_MAX_LENGTH

Tokenizer = Callable[[list[str]], Sequence[Sequence[int]]]


def render(
    df: DataFrame,
    template: str | Callable[[], Column],
    text_col: str = "text",
    *,
    null_policy: str = "empty",
    keep: Sequence[str] = (),
) -> DataFrame:
    """The `keep` columns and the rendered text. A template is a name or a function giving a column."""
    text = TEMPLATES[template](null_policy=null_policy) if isinstance(template, str) else template()
    return df.select(*keep, text.alias(text_col))


def close_sequences(
    df: DataFrame, ids_col: str = "ids", *, max_length: int = DEFAULT_MAX_LENGTH, eos_id: int = 0
) -> DataFrame:
    """Truncate and append EOS; still unpadded, the form to store, join and shuffle."""
    return df.withColumn(ids_col, append_eos(truncate(ids_col, max_length), eos_id))


def pad_and_label(
    df: DataFrame,
    ids_col: str = "ids",
    *,
    max_length: int = DEFAULT_MAX_LENGTH,
    eos_id: int = 0,
    pad_id: int | None = None,
    keep: Sequence[str] = (),
    check: bool = False,
) -> DataFrame:
    """Model inputs of closed sequences. Meant as the last projection before a write."""
    pad = pad_id_or_eos(pad_id, eos_id)
    input_ids = left_pad(ids_col, max_length, pad)
    return df.select(
        *keep,
        (rectangular(input_ids, max_length) if check else input_ids).alias("input_ids"),
        attention_mask(ids_col, max_length).alias("attention_mask"),
        left_padded_labels(ids_col, max_length, pad).alias("labels"),
    )


def assert_rectangular(df: DataFrame, max_length: int = DEFAULT_MAX_LENGTH) -> DataFrame:
    """What a batch collator relies on: the job fails if any of the three arrays is off length."""
    return df.withColumns(
        {c: rectangular(c, max_length) for c in ("input_ids", "attention_mask", "labels")}
    )


def sequences(
    df: DataFrame,
    template: str | Callable[[], Column],
    vocab: DataFrame | Mapping[str, int] | None = None,
    *,
    tokenizer: Tokenizer | None = None,
    setup: Callable[[], Tokenizer] | None = None,
    max_length: int = DEFAULT_MAX_LENGTH,
    eos_id: int = 0,
    unk_id: int = 0,
    specials: Iterable[str] = DECLARED_SPECIALS,
    null_policy: str = "empty",
    keep: Sequence[str] = (),
    form: str = "arrow",
) -> DataFrame:
    """Render, encode, truncate, append EOS: the `keep` columns, `ids` and `n_tokens`.

    `setup` builds a tokenizer inside the task. `n_tokens` counts the whole text, so `n_tokens >= max_length` marks truncated rows.
    """
    if sum(x is not None for x in (vocab, tokenizer, setup)) != 1:
        raise ValueError("give one of vocab, tokenizer and setup")
    rendered = render(df, template, "_text", null_policy=null_policy, keep=keep)
    room = max(max_length - 1, 0)
    if vocab is None:
        encoded = encode_with(rendered, tokenizer, "_text", setup=setup, count_col="n_tokens", max_tokens=room)
    else:
        encoded = encode(
            rendered,
            vocab,
            "_text",
            count_col="n_tokens",
            specials=specials,
            unk_id=unk_id,
            max_tokens=room,
            form=form,
        )
    return encoded.select(*keep, append_eos("ids", eos_id).alias("ids"), "n_tokens")


def prepare(
    df: DataFrame,
    template: str | Callable[[], Column],
    vocab: DataFrame | Mapping[str, int] | None = None,
    *,
    tokenizer: Tokenizer | None = None,
    setup: Callable[[], Tokenizer] | None = None,
    max_length: int = DEFAULT_MAX_LENGTH,
    eos_id: int = 0,
    pad_id: int | None = None,
    unk_id: int = 0,
    specials: Iterable[str] = DECLARED_SPECIALS,
    null_policy: str = "empty",
    keep: Sequence[str] = (),
    form: str = "arrow",
) -> DataFrame:
    """Corpus rows to model inputs in one shuffle-free stage; source columns are dropped."""
    closed = sequences(
        df,
        template,
        vocab,
        tokenizer=tokenizer,
        setup=setup,
        max_length=max_length,
        eos_id=eos_id,
        unk_id=unk_id,
        specials=specials,
        null_policy=null_policy,
        keep=keep,
        form=form,
    )
    return pad_and_label(closed, max_length=max_length, eos_id=eos_id, pad_id=pad_id, keep=keep)
