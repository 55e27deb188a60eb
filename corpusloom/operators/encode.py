"""Text to ids and back."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.sequences import append_eos_pair
from corpusloom.functions.text import GROUP_CHARS, decoded, grouped
from corpusloom.operators.lookup import ids_to_tokens
from corpusloom.operators.vocab import (
    AUTOMATON_FROM,
    CODE_SPACE,
    SPECIAL_MARKS,
    char_tokens,
    code_points,
    coder,
    marker,
    pieces,
    reachable_entries,
)
from corpusloom.schemas import DECLARED_SPECIALS, END_OF_TEXT

_ENCODED = "struct<ids:array<int>,n_tokens:int>"


def _encoded_array(
    ids: np.ndarray, lengths: Sequence[int], counts: Sequence[int | None]
) -> pa.StructArray:
    """Arrow column of (ids, n_tokens) rows from all ids in a row; a null count is a null row."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    n_tokens = pa.array(counts, pa.int32())
    lists = pa.ListArray.from_arrays(
        pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()), mask=n_tokens.is_null()
    )
    return pa.StructArray.from_arrays([lists, n_tokens], names=["ids", "n_tokens"])


def _in_groups(encode_group: Callable[[list[str | None]], pa.Array]) -> Callable:
    """Arrow UDF that gives the rows of a batch group by group: a task holds the batch, one group and its ids."""

    @F.arrow_udf(_ENCODED)
    def encode_texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for group in grouped(decoded(texts), GROUP_CHARS):
                yield encode_group(group)

    return encode_texts


def _arrow_encoder(
    entries: Mapping[str, int], specials: Sequence[str], unk_id: int, max_tokens: int | None
) -> Callable:
    """Arrow UDF: NFC, special split, id lookup.

    With each special marked as one code point, tokens are code points, so all texts of a group
    are looked up together in one table.
    """
    by_automaton = len(specials) > AUTOMATON_FROM
    first_special = CODE_SPACE if by_automaton else SPECIAL_MARKS
    by_code = {ord(t): i for t, i in entries.items() if len(t) == 1}
    by_code |= {first_special + i: entries.get(s, unk_id) for i, s in enumerate(specials)}
    known = np.fromiter(by_code.keys(), np.int64, len(by_code))
    known_ids = np.fromiter(by_code.values(), np.int32, len(by_code))
    top = int(known.max()) + 1 if len(known) else 0

    if by_automaton:
        code = coder(specials)

        def encode_codes(texts: list[str | None]) -> pa.Array:
            table = np.full(top + 1, unk_id, np.int32)
            table[known] = known_ids
            rows = [None if t is None else table[np.minimum(code(t), top)] for t in texts]
            kept = [np.empty(0, np.int32) if r is None else r[:max_tokens] for r in rows]
            ids = np.concatenate(kept) if kept else np.empty(0, np.int32)
            return _encoded_array(ids, [len(k) for k in kept], [None if r is None else len(r) for r in rows])

        return _in_groups(encode_codes)

    mark = marker(specials)

    def encode_texts(texts: list[str | None]) -> pa.Array:
        table = np.full(top + 1, unk_id, np.int32)
        table[known] = known_ids
        marked = [None if t is None else mark(t) for t in texts]
        kept = ["" if t is None else t[:max_tokens] for t in marked]
        lengths = [len(t) for t in kept]
        ids = np.empty(sum(lengths), np.int32)
        done = 0
        for piece in pieces(kept):
            ids[done : done + len(piece)] = table[np.minimum(code_points(piece), top)]
            done += len(piece)
        return _encoded_array(ids, lengths, [None if t is None else len(t) for t in marked])

    return _in_groups(encode_texts)


def _native_encoded(
    text: Column, entries: Mapping[str, int], specials: Sequence[str], unk_id: int, max_tokens: int | None
) -> Column:
    """The same on built-in functions: ids sit in a constant array indexed by code point."""
    chars = {ord(t): i for t, i in entries.items() if len(t) == 1}
    table = [unk_id] * (max(chars, default=0) + 1)
    for code, token_id in chars.items():
        table[code] = token_id
    by_code = F.from_json(F.lit(json.dumps(table)), "array<int>")

    def token_id(token: Column) -> Column:
        single = F.coalesce(F.get(by_code, F.ascii(token)), F.lit(unk_id))
        long_specials = [s for s in specials if len(s) > 1]
        if not long_specials:
            return single
        choice = F.when(F.length(token) == 1, single)
        for s in long_specials:
            choice = choice.when(token == s, F.lit(entries.get(s, unk_id)))
        return choice.otherwise(F.lit(unk_id))

    tokens = char_tokens(text, specials)
    kept = tokens if max_tokens is None else F.slice(tokens, 1, max_tokens)
    return F.struct(F.transform(kept, token_id).alias("ids"), F.size(tokens).alias("n_tokens"))


def encode(
    df: DataFrame,
    vocab: DataFrame | Mapping[str, int],
    text_col: str = "text",
    ids_col: str = "ids",
    *,
    count_col: str | None = None,
    specials: Iterable[str] = DECLARED_SPECIALS,
    unk_id: int = 0,
    max_tokens: int | None = None,
    form: str = "arrow",
) -> DataFrame:
    """Add the ids of a text column, without any appended special.

    The whole text is normalized, split and counted (`count_col`); `max_tokens` cuts the ids
    only. 'arrow' is the default; 'native' needs NFC text and runs without Python. Rows stay
    where they are: no shuffle.
    """
    specials = tuple(specials)
    entries = reachable_entries(vocab, specials)
    if form == "arrow":
        encoded = _arrow_encoder(entries, specials, unk_id, max_tokens)(F.col(text_col))
    elif form == "native":
        encoded = _native_encoded(F.col(text_col), entries, specials, unk_id, max_tokens)
    else:
        raise ValueError(f"form must be 'arrow' or 'native', not {form!r}")
    return _with_encoded(df, encoded, ids_col, count_col)


def encode_with(
    df: DataFrame,
    tokenizer: Callable[[list[str]], Sequence[Sequence[int]]] | None = None,
    text_col: str = "text",
    ids_col: str = "ids",
    *,
    setup: Callable[[], Callable[[list[str]], Sequence[Sequence[int]]]] | None = None,
    count_col: str | None = None,
    max_tokens: int | None = None,
) -> DataFrame:
    """As `encode` with the user's tokenizer: a function from a list of texts to id lists.

    It gets texts of about GROUP_CHARS characters at a time, whatever the size of the batches.

    `setup` builds that function inside the task instead, for tokenizers that cannot be
    pickled or are costly to load; it runs once per task.
    """
    if (tokenizer is None) == (setup is None):
        raise ValueError("give either tokenizer or setup")
    loaded: list[Callable] = []

    def encode_texts(strings: list[str | None]) -> pa.Array:
        if not loaded:
            loaded.append(tokenizer if tokenizer is not None else setup())
        present = [i for i, t in enumerate(strings) if t is not None]
        kept = [np.empty(0, np.int32)] * len(strings)
        counts: list[int | None] = [None] * len(strings)
        for i, ids in zip(present, loaded[0]([strings[i] for i in present]), strict=True):
            kept[i], counts[i] = np.asarray(ids[:max_tokens], np.int32), len(ids)
        all_ids = np.concatenate(kept) if kept else np.empty(0, np.int32)
        return _encoded_array(all_ids, [len(k) for k in kept], counts)

    return _with_encoded(df, _in_groups(encode_texts)(F.col(text_col)), ids_col, count_col)


def _with_encoded(df: DataFrame, encoded: Column, ids_col: str, count_col: str | None) -> DataFrame:
    kept = [F.col(c) for c in df.columns if c not in (ids_col, count_col)]
    wanted = [F.col("_encoded.ids").alias(ids_col)]
    if count_col is not None:
        wanted.append(F.col("_encoded.n_tokens").alias(count_col))
    return df.withColumn("_encoded", encoded).select(*kept, *wanted)


def encode_pair(
    df: DataFrame,
    vocab: DataFrame | Mapping[str, int],
    first_col: str,
    second_col: str,
    ids_col: str = "ids",
    *,
    eos_id: int = 0,
    specials: Iterable[str] = DECLARED_SPECIALS,
    unk_id: int = 0,
    form: str = "arrow",
) -> DataFrame:
    """Ids of two texts, each followed by EOS."""
    specials = tuple(specials)
    entries = reachable_entries(vocab, specials)
    options = {"specials": specials, "unk_id": unk_id, "form": form}
    both = encode(df, entries, first_col, "_first_ids", **options)
    both = encode(both, entries, second_col, "_second_ids", **options)
    return both.withColumn(ids_col, append_eos_pair("_first_ids", "_second_ids", eos_id)).drop(
        "_first_ids", "_second_ids"
    )


def decode(
    df: DataFrame,
    vocab: DataFrame | Mapping[str, int],
    ids_col: str = "ids",
    text_col: str = "text",
    *,
    unk_token: str = END_OF_TEXT,
    skip_ids: Iterable[int] = (),
) -> DataFrame:
    """Add the text of an id column; ids in `skip_ids` are left out before the lookup."""
    skip = sorted(set(skip_ids))
    kept = F.filter(F.col(ids_col), lambda i: ~i.isin(*skip)) if skip else F.col(ids_col)
    tokens = ids_to_tokens(df.withColumn("_kept_ids", kept), vocab, "_kept_ids", "_tokens", unk_token=unk_token)
    return tokens.withColumn(text_col, F.array_join("_tokens", "")).drop("_kept_ids", "_tokens")
