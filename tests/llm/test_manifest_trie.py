"""The Merkle manifest and the prefix trie against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import merkle, trie
from corpusloom.llm.order import positions

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, rank bigint, tree string, row string"


def h(*parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc) -> str:
    doc_id, text, lang, source, n_chars = doc[:5]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree_of(nodes: list[str]) -> tuple[str, list[list[str]]]:
    """The root and, for each leaf, its siblings level by level."""
    proofs, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for proof, i in zip(proofs, at):
            proof.append((level[i // 3 * 3 : i], level[i + 1 : i // 3 * 3 + 3]))
        at = [i // 3 for i in at]
        level = [h(*level[i : i + 3]) for i in range(0, len(level), 3)]
    return level[0], proofs


def brute_manifest(docs) -> list[tuple]:
    sources = {}
    for doc in docs:
        sources.setdefault(doc[3], []).append(doc)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    inner = {}
    for s in order:
        sources[s].sort(key=lambda d: (d[0] is not None, d[0] or 0, leaf_of(d)))
        inner[s] = tree_of([leaf_of(d) for d in sources[s]])
    root, upper = tree_of([inner[s][0] for s in order]) if order else ("", [])
    out = []
    for s, above in zip(order, upper):
        for doc, below in zip(sources[s], inner[s][1]):
            tampered = doc
            if doc[0] is not None and zlib.crc32(str(doc[0]).encode()) % 2 == 0 and doc[1] is not None:
                tampered = (doc[0], doc[1].replace("\n", ""), *doc[2:])
            folded = leaf_of(tampered)
            for left, right in below + above:
                folded = h(*left, folded, *right)
            siblings = [x for left, right in below + above for x in left + right]
            out.append((doc[0], leaf_of(doc), inner[s][0], root, h(*siblings), folded, folded == root))
    return sorted(out, key=str)


def manifest_rows(spark, docs):
    df = spark.createDataFrame([(*d, 1, "t", "r") for d in docs], DOCS)
    given = [F.col(c) for c in merkle.FIELDS]
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    bare = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    out = merkle.manifest(df, merkle.leaf_digest(*given), "doc_id", "source", {"tampered": merkle.leaf_digest(*given[:-1], bare)})
    fold = merkle.folded(F.col("tampered"), F.col("left"), F.col("right"))
    out = out.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("left"), F.col("right")).alias("p"), fold.alias("f"), (fold == F.col("root")).alias("v"))
    return sorted((tuple(r) for r in out.collect()), key=str)


def documents(n: int, seed: int) -> list[tuple]:
    rng = random.Random(seed)
    docs = [
        (
            rng.choice([None, rng.randrange(n), -rng.randrange(9)]) if rng.random() < 0.2 else i,
            rng.choice([None, "", "é\nü", "a\nb\n" * rng.randrange(5), "w" * rng.randrange(40)]),
            rng.choice([None, "", "en"]),
            rng.choice(["hot", "hot", "hot", None, "", "-", "=", "ä", f"s{rng.randrange(6)}"]),
            rng.choice([None, 0, rng.randrange(99)]),
        )
        for i in range(n)
    ]
    return docs + docs[: n // 10]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 27, 28, 200])
def test_manifest(spark, monkeypatch, n):
    monkeypatch.setattr(merkle, "LEVELS", 2)
    monkeypatch.setattr(merkle, "SEGMENT", 9)
    docs = documents(n, n)
    assert manifest_rows(spark, docs) == brute_manifest(docs)


def test_manifest_of_production_segments(spark):
    docs = [(i, f"text\n{i}", "en", "one" if i % 3 else "two", i) for i in range(merkle.SEGMENT * 2)]
    assert manifest_rows(spark, docs) == brute_manifest(docs)


def test_positions_of_groups_over_many_batches_and_tasks(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rng = random.Random(8)
        rows = [(rng.choice("aaaabbc") if i % 50 else f"own {i}", rng.randrange(900), i) for i in range(3000)]
        df = spark.createDataFrame(rows, "g string, k int, x int")
        got = {r["x"]: r["at"] for r in positions(df.repartition(7), "g", ["k", "x"], ["g", "x"], "at").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want, seen = {}, {}
    for g, _, x in sorted(rows):
        want[x] = seen[g] = seen.get(g, -1) + 1
    assert got == want


def test_manifest_of_nothing_and_of_a_long_text(spark):
    assert manifest_rows(spark, []) == []
    docs = [(7, "ü\n" * 1_000_000, None, None, None)]
    assert manifest_rows(spark, docs) == brute_manifest(docs)


def test_equal_rows_are_leaves_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "SEGMENT", 3)
    docs = [(5, "same", "en", "s", 4)] * 40
    assert manifest_rows(spark, docs) == brute_manifest(docs)


TURNS = "conv_id bigint, turn bigint, role string, text string, place bigint, conv string, h1 string"


def rebuilt(rows) -> dict[int, list[tuple[str, str]]]:
    turns: dict[int, list] = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in turns.items()}
    out = {}
    for c in own:
        k = zlib.crc32(str(c).encode()) % 4
        donor = c - int(np.fmod(c, 20))
        out[c] = own.get(donor, [])[:k] + own[c][k:]
    return out


def brute_trie(paths: dict[int, list]) -> list[tuple]:
    members: dict[tuple, list[int]] = {}
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children: dict[tuple, int] = {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    leaves: dict[tuple, int] = {}
    saved: dict[tuple, int] = {}
    for node, held in members.items():
        words = len([w for w in trie_words(node[-1][1])]) if node else 0
        for d in range(len(node) + 1):
            up = node[:d]
            leaves[up] = leaves.get(up, 0) + (node not in children)
            saved[up] = saved.get(up, 0) + (len(held) - 1) * words
    out = []
    for node, held in members.items():
        ends = ",".join(str(c) for c in sorted(held) if len(paths[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(held), len(node), parent, len(held), children.get(node, 0), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie_words(text: str) -> list[str]:
    return [w for w in text.translate({c: " " for c in range(9, 14)}).split(" ") if w]


def trie_rows(spark, rows, **sizes):
    df = spark.createDataFrame([(*r, 3, "c", "x") for r in rows], TURNS)
    turns = trie.numbered_turns(df)
    return sorted((tuple(r) for r in trie.trie(trie.grafted(turns), turns.select("conv"), **sizes).collect()), key=str)


def conversations(n: int, seed: int, longest: int) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for c in range(-9, n):
        if rng.random() < 0.15:
            continue
        for t in range(rng.choice([1, 2, 3, rng.randrange(1, longest)])):
            words = rng.choice(["a", "b c", "a", None, "", "long text\x0bof  words"]) if rng.random() < 0.9 else f"own {c}"
            rows.append((c, t if rng.random() < 0.95 else None, rng.choice(["user", None]) if t % 5 == 4 else "user", words))
    return rows + rows[:5] + [(None, 0, "user", "nobody")]


@pytest.mark.parametrize("sizes", [{}, {"segment": 3, "shard_turns": 10}, {"segment": 2, "shard_turns": 50}, {"segment": 5, "shard_turns": 1}])
def test_trie(spark, sizes):
    rows = conversations(60, 3, 14)
    assert trie_rows(spark, rows, **sizes) == brute_trie(rebuilt(rows))


def test_trie_of_nothing(spark):
    assert trie_rows(spark, []) == []
    assert trie_rows(spark, [(None, 1, "a", "b")]) == []


def test_conversation_without_turns_is_a_member_of_the_root(spark):
    ids = [c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3][:2]
    rows = [(c, 0, "user", "x") for c in ids]
    assert trie_rows(spark, rows) == brute_trie({c: [] for c in ids})


def test_copies_of_one_conversation_and_one_long_one(spark):
    copies = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(4)]
    long = [(1000, t, "user", f"turn {t}" if t < 700 else f"other {t % 7}") for t in range(1500)]
    also = [(1020, t, "user", f"turn {t}") for t in range(900)]
    rows = copies + long + also
    assert trie_rows(spark, rows, segment=64, shard_turns=200) == brute_trie(rebuilt(rows))


def test_double_array_holds_exactly_its_sequences():
    rng = np.random.default_rng(4)
    lengths = rng.integers(0, 6, 400)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    ids = rng.integers(0, 30, lengths.sum())
    built = trie.DoubleArray(ids, starts, lengths)
    cells = built.walk(ids, starts, lengths)
    paths = [tuple(ids[s : s + d + 1]) for s, n in zip(starts, lengths) for d in range(n)]
    assert (cells > 0).all()
    assert len(set(paths)) == len(set(zip(paths, cells))) == len(set(cells))
    missing = [p for p in {(int(a), int(b), int(c)) for a, b, c in rng.integers(0, 30, (300, 3))} if p not in set(paths)]
    flat = np.array(missing).reshape(-1)
    ends = built.walk(flat, np.arange(len(missing)) * 3, np.full(len(missing), 3))[2::3]
    assert (ends == trie.FREE).all()
