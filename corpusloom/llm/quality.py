"""Quality rules as a short-circuit cascade.

Every rule is a built-in expression over features of the text. A sample tells what each rule costs
and how many rows it rejects; rules then run in the order of rejections per cost, and the features of
a later rule are computed only for rows that no earlier rule has rejected. The order changes the work
and ``rejected_by``, never which rows are kept.

Words are ``[^\\x20\\x09-\\x0D]+``. A null text counts as an empty one, which ``few_words`` rejects;
texts of any length are read whole; equal rows get equal results; an empty table gives an empty
table. Input columns named like a result column are replaced by it.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import SPACE_CLASS, staged

WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """``reject`` is a condition over feature columns; ``needs`` names them."""

    name: str
    needs: tuple[str, ...]
    reject: Callable[[], Column]


def _windows(words: str) -> Column:
    """Hashes of all runs of five words; none for fewer words."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) >= WINDOW, hashes).otherwise(F.array().cast("array<bigint>"))


def _window_hashes() -> Column:
    h = F.col("_q_hashes")
    return F.transform(
        F.slice(h, F.lit(1), F.greatest(F.size(h) - (WINDOW - 1), F.lit(0))),
        lambda x, i: F.xxhash64(x, *(F.get(h, i + k) for k in range(1, WINDOW))),
    )


def _repeated_positions() -> Column:
    """Starts of the windows that are there twice or more, ascending."""
    s = F.col("_q_sorted")
    hit = F.filter(s, lambda e, i: (e["h"] == F.get(s, i - 1)["h"]) | (e["h"] == F.get(s, i + 1)["h"]))
    return F.sort_array(F.transform(hit, lambda e: e["p"]))


def _covered() -> Column:
    p = F.col("_q_starts")
    steps = F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW))))
    return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _lines() -> Column:
    return F.filter(F.split("_q_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


#: Steps to a feature, each over the text and what stands before it. A name with _q_ is dropped at the end.
STEPS: dict[str, tuple[tuple[str, ...], Callable[[], Column]]] = {
    "_q_words": ((), lambda: F.array_remove(F.split("_q_text", SPACE_CLASS + "+"), "")),
    "n_words": (("_q_words",), lambda: F.size("_q_words").cast("bigint")),
    "word_chars": (("_q_words",), lambda: F.length(F.array_join("_q_words", "")).cast("bigint")),
    "n_symbols": ((), lambda: F.length(F.regexp_replace("_q_text", r"[^#*$%&|<>]+", "")).cast("bigint")),
    "_q_lines": ((), _lines),
    "n_lines": (("_q_lines",), lambda: F.size("_q_lines").cast("bigint")),
    "n_dup_lines": (("_q_lines",), lambda: (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("bigint")),
    "n_letters": ((), lambda: F.length(F.regexp_replace("_q_text", r"\P{L}+", "")).cast("bigint")),
    "_q_hashes": (("_q_words",), lambda: _windows("_q_words")),
    "_q_windows": (("_q_hashes",), _window_hashes),
    "_q_sorted": (
        ("_q_windows",),
        lambda: F.when(
            F.size(F.array_distinct("_q_windows")) < F.size("_q_windows"),
            F.sort_array(F.transform("_q_windows", lambda x, i: F.struct(x.alias("h"), i.alias("p")))),
        ).otherwise(F.array().cast("array<struct<h:bigint,p:int>>")),
    ),
    "_q_starts": (("_q_sorted",), _repeated_positions),
    "n_repeat_words": (("_q_starts",), _covered),
}

BASE_RULES = (
    Rule("few_words", ("n_words",), lambda: F.col("n_words") < 10),
    Rule("repeated_words", ("n_repeat_words", "n_words"), lambda: 100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
)
RULES = BASE_RULES + (
    Rule("symbols", ("n_symbols", "n_words"), lambda: 10 * F.col("n_symbols") > 3 * F.col("n_words")),
    Rule("repeated_lines", ("n_dup_lines", "n_lines"), lambda: 2 * F.col("n_dup_lines") > F.col("n_lines")),
    Rule("short_words", ("word_chars", "n_words"), lambda: 2 * F.col("word_chars") < 5 * F.col("n_words")),
    Rule("long_words", ("word_chars", "n_words"), lambda: F.col("word_chars") > 15 * F.col("n_words")),
    Rule("few_letters", ("n_letters", "word_chars"), lambda: 2 * F.col("n_letters") < F.col("word_chars")),
)
#: The counts that op1 returns.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _closure(names: tuple[str, ...]) -> list[str]:
    """The steps to these features in order of need."""
    out: list[str] = []

    def add(name: str) -> None:
        for before in STEPS[name][0]:
            add(before)
        if name not in out:
            out.append(name)

    for name in names:
        add(name)
    return out


def with_features(df: DataFrame, names: tuple[str, ...], only_if: Column | None = None, done: tuple[str, ...] = ()) -> DataFrame:
    """Adds features over ``_q_text``; with ``only_if``, null where it is false."""
    for name in _closure(names):
        if name not in done:
            made = STEPS[name][1]()
            df = df.withColumn(name, made if only_if is None else F.when(only_if, made))
    return df


def estimate(df: DataFrame, text: str, rules=RULES, sample_rows: int = 400, sample_chars: int = 20_000) -> list[tuple[str, float, float]]:
    """(rule, seconds, share rejected) from a sample of at most ``sample_rows`` texts of at most ``sample_chars`` characters.

    The sample is what a few partitions give first. It decides the order of the rules only.
    """
    rows = df.select(F.col(text).alias("_q_text")).where(F.length("_q_text") <= sample_chars).take(sample_rows)
    if not rows:
        return [(r.name, 1.0, 0.0) for r in rules]
    sample = staged(df.sparkSession.createDataFrame(rows, "_q_text string"), "rule_sample")
    out = []
    for rule in rules:
        ready = with_features(sample, rule.needs).agg(F.avg(F.coalesce(rule.reject(), F.lit(False)).cast("int")))
        ready.collect()  # compiles
        start = time.perf_counter()
        share = ready.first()[0]
        out.append((rule.name, time.perf_counter() - start, float(share)))
    return out


def ordered(rules, estimates: list[tuple[str, float, float]]) -> list[Rule]:
    """Rules by rejections per cost, highest first; cheaper ones first among equals."""
    found = {name: (-share / max(cost, 1e-9), cost) for name, cost, share in estimates}
    return sorted(rules, key=lambda r: found[r.name])


def cascade(df: DataFrame, text: str = "text", rules=RULES, estimates=None, features: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``rejected_by`` (null: kept) and ``kept``.

    ``features`` are returned for every row, also for rejected ones; all other features are computed
    only as far as the cascade gets. ``estimates`` as from ``estimate``, which is called if not given.
    """
    rules = ordered(rules, estimates if estimates is not None else estimate(df, text, rules))
    given = [c for c in df.columns if c not in (*STEPS, "rejected_by", "kept", "_q_text", *features)]
    out = df.select(*(F.col(f"`{c}`") for c in given), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_q_text"))
    out = with_features(out, features).withColumn("rejected_by", F.lit(None).cast("string"))
    done = tuple(_closure(features))
    for rule in rules:
        open_row = F.col("rejected_by").isNull()
        out = with_features(out, rule.needs, only_if=open_row, done=done)
        done = (*done, *(x for x in _closure(rule.needs) if x not in done))
        out = out.withColumn("rejected_by", F.when(open_row & rule.reject(), F.lit(rule.name)).otherwise(F.col("rejected_by")))
    return out.select(*(F.col(f"`{c}`") for c in given), *features, "rejected_by", F.col("rejected_by").isNull().alias("kept"))


def op1_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Counts, base rules and the verdict of the cascade for every document."""
    from corpusloom.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = cascade(docs, features=COUNTS)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return out.select("doc_id", *COUNTS, failed.alias("base_failed"), "kept")


OP1_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
parts AS (SELECT rid, doc_id, text,
    list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM docs),
runs AS (SELECT rid, unnest(range(1, len(words) - 3)) AS p, words FROM parts WHERE len(words) >= 5),
keyed AS (SELECT rid, p, array_to_string(words[p:p + 4], ' ') AS run FROM runs),
counted AS (SELECT rid, p, count(*) OVER (PARTITION BY rid, run) AS n FROM keyed),
gaps AS (SELECT rid, least(5, coalesce(lead(p) OVER (PARTITION BY rid ORDER BY p) - p, 5)) AS step FROM counted WHERE n > 1),
repeated AS (SELECT rid, CAST(sum(step) AS BIGINT) AS n_repeat_words FROM gaps GROUP BY rid),
counts AS (SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(length(regexp_replace(text, '\P{L}+', '', 'g')) AS BIGINT) AS n_letters
  FROM parts LEFT JOIN repeated USING (rid)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > 3 * n_words OR 2 * n_dup_lines > n_lines
    OR 2 * word_chars < 5 * n_words OR word_chars > 15 * n_words OR 2 * n_letters < word_chars) AS kept
FROM judged
"""
