"""Quality rules, sharding and line dedup: DataFrame operators on small tables with odd rows."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import line_dedup, quality, sharding
from corpusloom.llm.words import shingle_set, word_hashes

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def repeat_words(text):
    w = words(text)
    runs = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    count = Counter(runs)
    return len({i + k for i, r in enumerate(runs) if count[r] > 1 for k in range(5)})


TEXTS = [
    None,
    "",
    " \t\n\x0b\x0c\r ",
    "one two three four five six seven eight nine ten eleven",
    "a b c d e a b c d e",
    "x x x x x x x x x x x x",
    "x x x x x",
    "q w e r t y\nq w e r t y\n\n \nq w e r t y",
    "é ü　z 😀 #*$ %&|<> ok",
    "a b c d e f a b c d e g a b c d",
    "word " * 3000 + "end",
    "1 2 3 4 5 6 7 8 9 10 11 12 13 14",
]


@pytest.fixture(scope="module")
def counted(spark):
    rows = [(i, t, "kept twice") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "again")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_words string")
    return quality.cascade(df, features=quality.COUNTS).collect()


def test_counts_equal_brute_force(counted):
    assert len(counted) == len(TEXTS) + 1
    for r in counted:
        t = TEXTS[r["doc_id"]] or ""
        w = words(t)
        lines = [x for x in t.split("\n") if words(x)]
        assert r["n_words"] == len(w)
        assert r["word_chars"] == sum(map(len, w))
        assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in t)
        assert r["n_dup_lines"] == len(lines) - len(set(lines))
        assert r["n_repeat_words"] == repeat_words(t), t[:40]


def test_verdict_does_not_depend_on_order(spark, counted):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id bigint, text string")
    kept = {r["doc_id"]: r["kept"] for r in counted}
    for flip in (1, -1):
        order = [(r.name, 1.0, flip * k / 10) for k, r in enumerate(quality.RULES)]
        got = quality.cascade(df, estimates=order).collect()
        assert {r["doc_id"]: r["kept"] for r in got} == kept
        assert all(r["kept"] == (r["rejected_by"] is None) for r in got)
    assert kept[3] and not kept[0] and not kept[1] and not kept[5]


def test_rules_are_ordered_by_rejection_per_cost():
    found = [(r.name, 2.0 if r.name == "few_words" else 1.0, 0.3 if r.name == "few_words" else 0.2) for r in quality.RULES]
    assert quality.ordered(quality.RULES, found)[-1].name == "few_words"


def test_quality_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert quality.cascade(df, features=quality.COUNTS).collect() == []


def test_shards_have_exact_sizes_and_gapless_slots(spark):
    rows = [(i if i % 7 else None, "same", i) for i in range(1003)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, slot bigint").repartition(5)
    got = sharding.shard(df, 8).collect()
    sizes = Counter(r["shard"] for r in got)
    assert len(got) == 1003 and sorted(sizes) == list(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sizes[s]))
    assert Counter(r["doc_id"] for r in got)[None] == 144
    assert sharding.shard(df.limit(0), 8).collect() == []
    assert sorted(sharding.shard(df.limit(3), 8).columns) == ["doc_id", "shard", "slot", "text"]


def test_large_draws_follow_the_law():
    rng = np.random.Generator(np.random.PCG64(3))
    good, bad, n = 3 * 10**9, 10**10, 1000
    drawn = np.array([sharding._hypergeometric(rng, good, bad, n) for _ in range(20_000)])
    p = good / (good + bad)
    assert abs(drawn.mean() - n * p) < 0.5
    assert abs(drawn.var() / (n * p * (1 - p)) - 1) < 0.05
    assert abs(((drawn - drawn.mean()) ** 3).mean() / drawn.std() ** 3 - (1 - 2 * p) / np.sqrt(n * p * (1 - p))) < 0.08
    # Few of many: the normal law would be far off.
    few = np.array([sharding._hypergeometric(rng, 10**9, 10**12, 900) for _ in range(20_000)])
    assert abs((few == 0).mean() - np.exp(-0.8991)) < 0.02
    assert sharding._hypergeometric(rng, 10**10, 0, 7) == 7 and sharding._hypergeometric(rng, 0, 10**10, 7) == 0
    assert sharding._hypergeometric(rng, 10**9, 10**9, 2 * 10**9) == 10**9
    # Where numpy draws as well, both agree.
    ours = [sharding._by_weights(rng, 40, 60, 30) for _ in range(20_000)]
    theirs = rng.hypergeometric(40, 60, 30, 20_000)
    a, b = (np.bincount(x, minlength=31) / 20_000 for x in (ours, theirs))
    assert np.abs(a - b).max() < 0.015


def test_matrix_follows_the_hypergeometric_law():
    sizes = np.array([3, 3, 4])
    drawn = [sharding.draw(np.array([4, 6]), sizes, [1, k]) for k in range(4000)]
    assert all((m.sum(axis=0) == sizes).all() and (m.sum(axis=1) == [4, 6]).all() for m in drawn)
    share = Counter(int(m[0, 0]) for m in drawn)
    want = {0: 35 / 210, 1: 105 / 210, 2: 63 / 210, 3: 7 / 210}  # C(3,k) C(7,4-k) / C(10,4)
    for k, p in want.items():
        assert abs(share[k] / 4000 - p) < 0.03
    large = sharding.draw(np.array([3 * 10**9, 10**9]), np.array([2 * 10**9, 2 * 10**9]), [5])
    assert (large.sum(axis=0) == 2 * 10**9).all() and (large.sum(axis=1) == [3 * 10**9, 10**9]).all()


def _documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 1) for i, t, s in rows], DOCS)


def test_common_lines_go_and_copies_stay(spark):
    common = "All rights reserved here."
    rows = [(i, f"Body of text number {i} long enough.\n  {common}\t\n\nMore {i}", f"s{i % 12}") for i in range(30)]
    rows += [(100 + i, "A copied article.\nWith its second line.", f"s{i % 12}") for i in range(24)]  # many sites, one text
    rows += [(500 + i, f"A thirteen-site line.\nText {i % 12} of its own", s) for i in range(13) for s in ("a-hot", f"s{i}")]
    rows += [(600 + i, f"w {i}\nOne long notice that stands under twelve short pages.", f"s{i}") for i in range(12)]
    rows += [(200, common, "s1"), (201, None, "s1"), (202, "", None), (203, f"{common}\nA text without a site, and long.", None)]
    rows += [(300 + i, f"Line of nine sites.\nUnique {i} text of its own here", f"s{i % 9}") for i in range(40)]
    rows += [(400 + i, f"Line of ten sites.\nUnique {i} text of its own here", f"s{i % 10}") for i in range(40)]
    docs = _documents(spark, rows)
    got = {r["doc_id"]: r for r in line_dedup.line_dedup(docs).collect()}
    assert len(got) == len({r[0] for r in rows})
    lines = line_dedup.boilerplate(docs)
    sent, joined = (line_dedup.remove_lines(docs, lines, most=m) for m in (99, 0))
    assert sorted(map(str, sent.collect())) == sorted(map(str, joined.collect()))
    assert got[0]["text"] == "Body of text number 0 long enough.\n\nMore 0" and got[0]["n_lines_removed"] == 1
    assert got[100]["text"] == rows[30][1] and got[200]["text"] == "" and got[200]["n_lines_removed"] == 1
    assert all(got[500 + i]["n_lines_removed"] == 1 for i in range(13))
    assert all(got[600 + i]["text"] == f"w {i}" for i in range(12))
    assert got[201]["text"] is None and got[202]["text"] == ""
    assert got[203]["text"] == "A text without a site, and long."
    assert got[300]["n_lines_removed"] == 0 and got[400]["n_lines_removed"] == 1


def test_near_threshold_lines_are_counted_exactly(spark):
    rows = [(i, f"Shared {k}\nOwn text {i} that is long enough to stay", f"s{i % k}") for k in (48, 49, 50, 51) for i in range(60)]
    found = line_dedup.boilerplate(_documents(spark, rows), min_sites=50, margin=0.1).collect()
    want = spark.createDataFrame([("Shared 50",), ("Shared 51",)], "a string").select(F.xxhash64("a").alias("line")).collect()
    assert sorted(r["line"] for r in found) == sorted(r["line"] for r in want)


def test_line_dedup_of_an_empty_table(spark):
    out = line_dedup.line_dedup(_documents(spark, []))
    assert out.collect() == [] and out.columns[-1] == "n_lines_removed"


def test_word_hashes_and_shingles():
    text = "The quick  brown\tfox ÉÉ " + "z" * 70_000 + " end " + "w " * 40_000
    got = word_hashes(text.encode())
    assert len(got) == len(words(text)) and len(set(got.tolist())) == len(set(words(text.replace("T", "t"))))
    assert (word_hashes(b"A b\nC") == word_hashes(b" a B c ")).all()
    assert len(word_hashes(b"")) == len(shingle_set(word_hashes(b" \n"))) == 0
    assert len(shingle_set(word_hashes(b"a b c"))) == 1 and len(shingle_set(word_hashes(b"a b c d e f"))) == 2
    assert shingle_set(word_hashes(b"a b")) != shingle_set(word_hashes(b"b a"))
