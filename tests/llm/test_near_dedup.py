"""Near-duplicates and components against brute force, with groups of more than one block."""

from __future__ import annotations

import random
import re

import pytest

from corpusloom.llm import near_dedup
from corpusloom.llm.components import components


def sets_of(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_force(rows, percent):
    sets = [sets_of(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                group[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return {doc_id: (len(s), least[root(i)]) for i, ((doc_id, _), s) in enumerate(zip(rows, sets))}


def edited(words, changes, r):
    out = list(words)
    for _ in range(changes):
        out[r.randrange(len(out))] = f"new{r.randrange(10**6)}"
    return " ".join(out)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for base in range(12):
        words = [r.choice(vocabulary) for _ in range(r.randrange(30, 160))]
        out += [edited(words, k, r) for k in range(0, 9)]
    out += ["", None, " \n ", "Short text", "short  TEXT", "a b c d e", "A b c d E", "a b c d e f", "é É", "É é"]
    out += [out[0], out[0].upper(), "very long " + " ".join(r.choice(vocabulary) for _ in range(30_000))]
    ids = r.sample(range(10_000), len(out))
    return list(zip(ids, out))


@pytest.mark.parametrize("percent", [85, 80])
def test_equal_to_brute_force(spark, rows, percent):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, component_id string")
    got = {r["doc_id"]: r for r in near_dedup.near_duplicates(df, percent).collect()}
    want = brute_force(rows, percent)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_groups_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "SIGNATURE_BLOCK", 8)
    monkeypatch.setattr(near_dedup, "SET_BLOCK", 8)
    r = random.Random(2)
    words = [f"w{r.randrange(300)}" for _ in range(120)]
    rows = [(i, edited(words, r.randrange(0, 6), r)) for i in range(90)]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 85).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_force(rows, 85)


def test_null_ids_repeated_rows_and_empty_tables(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(5, text), (5, text), (None, text), (None, "alone as it is here"), (7, text + " more"), (8, None), (8, None)]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 85).collect()
    assert len(got) == len(rows)
    found = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in got), key=str)
    assert found == sorted([(5, 5, True), (5, 5, True), (None, 5, False), (None, None, True), (7, 5, False), (8, 8, True), (8, 8, True)], key=str)
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert near_dedup.near_duplicates(empty, 85).collect() == []


def test_an_id_never_links_texts(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    schema = "doc_id bigint, text string, row string"
    kept = near_dedup.drop_near_duplicates(spark.createDataFrame([(1, a, "x"), (5, a, "y"), (5, b, "z")], schema), 80)
    assert sorted(map(tuple, kept.collect())) == [(1, a, "x"), (5, b, "z")]
    assert kept.columns == ["doc_id", "text", "row"]
    rows = [(5, a), (5, b), (7, a), (8, b), (9, b + " end")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = sorted(map(tuple, near_dedup.drop_near_duplicates(df, 80).collect()))
    assert kept == sorted([(5, a), (5, b)])
    # 7 and 8 share nothing: both components happen to have 5 as their smallest id.
    found = {(r["doc_id"], r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(df, 80).collect()}
    assert found == {(5, 5, True), (7, 5, False), (8, 5, False), (9, 5, False)}


def test_one_row_of_each_group_stays(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(5, text), (5, text), (5, text + " x"), (None, text), (None, text), (7, text + " more"), (8, None), (8, None), (9, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = sorted(map(str, near_dedup.drop_near_duplicates(df, 80).collect()))
    assert len([r for r in kept if "doc_id=5" in r]) == 1
    assert len(kept) == 1 + 2 + 2 + 1


def test_recall_at_the_threshold(spark):
    """Pairs at a similarity just above the threshold are all found."""
    r = random.Random(11)
    rows = []
    for k in range(150):
        words = [f"p{k}w{i}" for i in range(204)]  # 200 shingles
        other = [*words]
        at = r.randrange(20, 180)
        for i in range(at, at + 12):  # 16 shingles differ: 184 / 216 = 0.852
            other[i] = f"p{k}other{i}"
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(other))]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 85).collect()
    assert sum(not x["kept"] for x in got) == 150


def test_bit_counts_of_lanes():
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(2)
    signatures = rng.integers(0, 3, (20, near_dedup.HASHES)).astype(np.uint8)
    group = pa.table({"signature": pa.array([s.tobytes() for s in signatures], pa.binary())})
    equal = (signatures[:, None] == signatures[None]).sum(axis=2)
    assert np.allclose(near_dedup.estimates(group), (equal / near_dedup.HASHES - 1 / 256) / (1 - 1 / 256))


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(1000, 1000 + i) for i in range(1, 30)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame([*path, *star, (2000, 2000)], "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {1000 + i: 1000 for i in range(30)}
