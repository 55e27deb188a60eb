"""Vocabulary tables: compatibility, derived from a corpus, inverted, exported."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.functions.text import decoded
from corpusloom.schemas import COMPAT_VOCAB, DECLARED_SPECIALS, VOCABULARY

# A character vocabulary cannot outgrow the code space, so this bounds what may be
# collected, sent to tasks or ranked in one partition. Larger tables take the join form.
CODE_SPACE = 0x110000
MAX_LOCAL_ENTRIES = CODE_SPACE + 1024

# Surrogate code points, one for each special token of a text in work.
SPECIAL_MARKS = 0xD800
N_MARKS = 0x800

# More specials than these are found by an automaton; so many it may have.
AUTOMATON_FROM = 64
MAX_SPECIALS = 1_000_000

# Characters handled at a time, which bounds the working memory of a batch.
CHUNK = 1 << 17


def compat_vocab(spark: SparkSession) -> DataFrame:
    return _local_vocab(spark, COMPAT_VOCAB)


def _local_vocab(spark: SparkSession, entries: Mapping[str, int]) -> DataFrame:
    """The entries as a local table; one made from a list of rows would need Python workers of its own."""
    columns = [pa.array(list(entries), pa.string()), pa.array(list(entries.values()), pa.int32())]
    return spark.createDataFrame(pa.table(columns, names=VOCABULARY.names), VOCABULARY)


def marker(specials: Iterable[str]) -> Callable[[str], str]:
    """Function giving the NFC text with each special as one code point, SPECIAL_MARKS + its index.

    The marks are surrogates, which no text read from UTF-8 can hold.
    """
    specials = list(specials)
    if len(specials) > N_MARKS:
        raise ValueError(f"more than {N_MARKS} specials")
    marks = {s: chr(SPECIAL_MARKS + i) for i, s in enumerate(specials)}
    longest_first = sorted(marks, key=len, reverse=True)
    if any(_overlap(a, b) for a in specials for b in specials if a != b):
        pattern = re.compile("|".join(map(re.escape, longest_first)))
        return lambda text: pattern.sub(
            lambda m: marks[m.group()], unicodedata.normalize("NFC", text)
        )

    def mark(text: str) -> str:
        text = unicodedata.normalize("NFC", text)
        for special in longest_first:
            text = text.replace(special, marks[special])
        return text

    return mark


def coder(specials: Iterable[str]) -> Callable[[str], np.ndarray]:
    """Function giving the code points of the NFC text with each special as one, CODE_SPACE + its index.

    Like the marker, it takes the leftmost special, of several there the longest. One automaton finds the places of all
    specials in one pass, so the time does not grow with their number.
    """
    specials = list(specials)
    if len(specials) > MAX_SPECIALS:
        raise ValueError(f"more than {MAX_SPECIALS} specials")
    built: list = []

    def code(text: str) -> np.ndarray:
        if not built:  # in the task
            import ahocorasick

            automaton = ahocorasick.Automaton()
            for i, special in enumerate(specials):
                automaton.add_word(special, (i, len(special)))
            automaton.make_automaton()
            built.append(automaton)
        text = unicodedata.normalize("NFC", text)
        codes = code_points(text).astype(np.int32)
        found = sorted((end - size + 1, -size, i) for end, (i, size) in built[0].iter(text))
        if not found:
            return codes
        kept, behind = np.ones(len(codes), dtype=bool), 0
        for start, size, i in found:
            if start >= behind:
                behind = start - size
                codes[start] = CODE_SPACE + i
                kept[start + 1 : behind] = False
        return codes[kept]

    return code


def _overlap(first: str, second: str) -> bool:
    """Whether an occurrence of one can share characters with an occurrence of the other."""
    return second in first or any(first.endswith(second[:n]) for n in range(1, len(second)))


def char_tokens(text: Column | str, specials: Iterable[str] = DECLARED_SPECIALS) -> Column:
    """One token per code point, declared specials kept whole; [] for the empty string."""
    alternatives = sorted(specials, key=len, reverse=True)
    pattern = "|".join([rf"\Q{s}\E" for s in alternatives] + ["."])
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(c, F.lit(f"(?s){pattern}"), F.lit(0))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def pieces(texts: Iterable[str]) -> Iterator[str]:
    """The texts one after the other in pieces of about CHUNK characters."""
    group: list[str] = []
    size = 0
    for text in texts:
        for start in range(0, len(text), CHUNK):
            group.append(text[start : start + CHUNK])
            size += len(group[-1])
            if size >= CHUNK:
                yield "".join(group)
                group, size = [], 0
    if group:
        yield "".join(group)


def token_counts(
    df: DataFrame,
    text_col: str = "text",
    *,
    specials: Iterable[str] = DECLARED_SPECIALS,
    form: str = "arrow",
) -> DataFrame:
    """(token, n) over the whole NFC texts, specials left out.

    'arrow' counts code points per task, so only one row per task and character is shuffled
    however long or repeated the texts are. 'native' explodes the characters instead and
    expects NFC text.
    """
    specials = tuple(specials)
    if form == "native":
        tokens = df.select(F.explode(char_tokens(text_col, specials)).alias("token"))
        if specials:
            tokens = tokens.where(~F.col("token").isin(*specials))
        return tokens.groupBy("token").agg(F.count("*").alias("n"))
    if form != "arrow":
        raise ValueError(f"form must be 'arrow' or 'native', not {form!r}")

    by_automaton = len(specials) > AUTOMATON_FROM
    mark, code = (None, coder(specials)) if by_automaton else (marker(specials), None)

    def count_in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(CODE_SPACE, np.int64)
        for batch in batches:
            texts = (t for t in decoded(batch.column(0)) if t)
            for codes in map(code, texts) if by_automaton else map(code_points, pieces(map(mark, texts))):
                found = np.bincount(codes)[:CODE_SPACE]
                totals[: len(found)] += found
        totals[SPECIAL_MARKS : SPECIAL_MARKS + N_MARKS] = 0
        seen = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array([chr(c) for c in seen], pa.string()), pa.array(totals[seen], pa.int64())],
            names=["token", "n"],
        )

    return (
        df.select(text_col)
        .mapInArrow(count_in_task, "token string, n long")
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
    )


def corpus_vocab(
    df: DataFrame,
    text_col: str = "text",
    *,
    specials: Iterable[str] = DECLARED_SPECIALS,
    reserved: Mapping[str, int] = COMPAT_VOCAB,
    min_count: int = 1,
    max_size: int | None = None,
    form: str = "arrow",
) -> DataFrame:
    """(token, id): reserved entries, then characters by falling count, ties by code point.

    max_size bounds the whole vocabulary, reserved entries included. The ranking runs in one
    partition over the counted table, which the code space bounds.
    """
    counts = token_counts(df, text_col, specials=specials, form=form)
    if reserved:
        counts = counts.where(~F.col("token").isin(*reserved))
    first_id = max(reserved.values(), default=-1) + 1
    ranked = counts.where(F.col("n") >= min_count).select(
        "token",
        (F.row_number().over(W.orderBy(F.desc("n"), F.asc("token"))) + (first_id - 1)).alias("id"),
    )
    if max_size is not None:
        ranked = ranked.where(F.col("id") < first_id + max(max_size - len(reserved), 0))
    if not reserved:
        return ranked
    return _local_vocab(df.sparkSession, reserved).unionByName(ranked)


def invert(vocab: DataFrame) -> DataFrame:
    """(id, token) of a vocabulary table."""
    return vocab.select("id", "token")


def invert_map(m: Column | str) -> Column:
    """Map column with keys and values exchanged."""
    c = F.col(m) if isinstance(m, str) else m
    return F.map_from_entries(
        F.transform(F.map_entries(c), lambda e: F.struct(e["value"].alias("key"), e["key"].alias("value")))
    )


def as_map(vocab: DataFrame) -> DataFrame:
    """One row with the vocabulary as a map ordered by id; fails above MAX_LOCAL_ENTRIES."""
    entries = F.array_sort(F.collect_list(F.struct("id", "token")))
    by_token = F.map_from_entries(F.transform(entries, lambda e: F.struct(e["token"], e["id"])))
    too_large = F.raise_error(F.lit(f"vocabulary has more than {MAX_LOCAL_ENTRIES} entries"))
    return vocab.limit(MAX_LOCAL_ENTRIES + 1).agg(
        F.when(F.count("*") <= MAX_LOCAL_ENTRIES, by_token).otherwise(too_large).alias("vocab")
    )


def reachable_entries(
    vocab: DataFrame | Mapping[str, int], specials: Iterable[str] = DECLARED_SPECIALS
) -> dict[str, int]:
    """The entries a character tokenizer can produce: single code points and the specials.

    Their number is bounded by the code space however large the vocabulary table is.
    """
    specials = tuple(specials)
    if isinstance(vocab, Mapping):
        return {t: i for t, i in vocab.items() if len(t) == 1 or t in specials}
    wanted = F.length("token") == 1
    if specials:
        wanted = wanted | F.col("token").isin(*specials)
    rows = vocab.where(wanted).select("token", "id").limit(MAX_LOCAL_ENTRIES + 1).collect()
    if len(rows) > MAX_LOCAL_ENTRIES:
        raise ValueError("vocabulary has more single-character rows than code points: tokens repeat")
    return {r["token"]: r["id"] for r in rows}


def save_vocabulary(vocab: DataFrame, directory: str, filename_prefix: str | None = None) -> tuple[str]:
    """Write the token to id object under `[prefix-]vocab.json` and return the path."""
    path = f"{directory.rstrip('/')}/{filename_prefix + '-' if filename_prefix else ''}vocab.json"
    as_map(vocab).select(F.to_json("vocab").alias("value")).coalesce(1).write.mode("overwrite").text(path)
    return (path,)


def load_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    parsed = spark.read.text(path, wholetext=True).select(
        F.from_json("value", "map<string,int>").alias("vocab")
    )
    return parsed.select(F.explode("vocab").alias("token", "id"))
