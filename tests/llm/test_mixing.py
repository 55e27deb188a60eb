"""The language model against counting by hand, a bit-by-bit form of its predictions, and its own laws."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import mixing
from corpusloom.llm.mixing import BITS, ORDERS, STARTS, ByteCode, Model

SYLLABLES = ["an", "the", "ing", "é", "ou", "re", "st", "x"]


def prose(rng, n: int) -> str:
    words = ["".join(rng.choice(SYLLABLES) for _ in range(int(rng.integers(1, 4)))) for _ in range(n)]
    return "".join(w.capitalize() + str(rng.choice([" ", "\n", " \t"])) for w in words)


def tokens(text: str | None) -> list[str]:
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), ""]


def counted(code: ByteCode, docs: list[bytes]) -> np.ndarray:
    counts = np.zeros(2 * STARTS[-1], dtype=np.uint32)
    times = mixing.Times(lambda keys, n: mixing._add_contexts(counts, code, keys, n))
    for keys, _ in mixing.grouped(docs):
        times.add(keys)
    times.close()
    return counts.reshape(-1, 2)


@pytest.fixture(scope="module")
def trained():
    rng = np.random.default_rng(5)
    docs = [mixing.normalized(prose(rng, 300).encode()) for _ in range(30)]
    code = ByteCode.of(np.bincount(np.frombuffer(b"".join(docs), dtype=np.uint8), minlength=256))
    first = Model.of(code, counted(code, docs[:20]))
    model, seen, _ = mixing.learn_weights(first, docs[20:])
    model.refined = (seen[1] + 16 * model.refined) / (seen[0] + 16)
    return docs, code, model


def test_normal_form():
    assert mixing.normalized(None) == mixing.normalized(b"") == mixing.normalized(b" \t\n") == b"\n"
    assert mixing.normalized("  Éa B\x0bÇ c\n".encode()) == "Éa b Ç c \n".encode()


def test_code_is_a_prefix_code(trained):
    code = trained[1]
    ways = {"".join(map(str, code.bits[: code.lengths[b], b])) for b in range(256)}
    assert len(ways) == 256
    assert math.isclose(sum(2.0 ** -len(w) for w in ways), 1)


def test_counts_equal_counting_bit_by_bit(trained):
    docs, code, _ = trained
    want = Counter()
    for doc in docs[:2]:
        padded = b"\n" * 5 + doc
        for at, byte in enumerate(doc):
            for k in range(code.lengths[byte]):
                for i, order in enumerate(ORDERS):
                    context = np.array([int.from_bytes(padded[at + 5 - order : at + 5], "little")], dtype=np.uint64)
                    hashed = context * mixing.ODD[i] + mixing.ODD[i + 5]
                    slot = int(mixing.slots(hashed, code.nodes[k : k + 1, byte], i)[0])
                    assert STARTS[i] <= slot < STARTS[i] + (1 << BITS[i])
                    want[slot, int(code.bits[k, byte])] += 1
    got = counted(code, docs[:2])
    assert {(int(a), int(b)): int(got[a, b]) for a, b in zip(*np.nonzero(got))} == dict(want)


def test_probabilities_of_all_next_bytes_add_up(trained):
    _, _, model = trained
    rng = np.random.default_rng(1)
    for _ in range(20):
        before = rng.choice(np.frombuffer(b"an the\nxq\xc3\xa9", dtype=np.uint8), 5).tobytes()
        keys = np.array([int.from_bytes(before + bytes([b]), "little") for b in range(256)], dtype=np.uint64)
        assert math.isclose(np.exp(model.log_probabilities(keys)).sum(), 1, rel_tol=1e-6)


def test_log_probability_is_that_of_the_rule_bit_by_bit(trained):
    docs, code, model = trained
    doc = docs[25][:200]
    padded, total = b"\n" * 5 + doc, 0.0
    for at, byte in enumerate(doc):
        for k in range(code.lengths[byte]):
            node, bit = int(code.nodes[k, byte]), int(code.bits[k, byte])
            odds, met = [], []
            for i, order in enumerate(ORDERS):
                context = np.array([int.from_bytes(padded[at + 5 - order : at + 5], "little")], dtype=np.uint64)
                slot = int(mixing.slots(context * mixing.ODD[i] + mixing.ODD[i + 5], np.array([node]), i)[0])
                odds.append(float(model.odds[slot]))
                met.append(int(model.met[slot]))
            gate = met[-1] * 4 + met[-2]
            mixed = sum(o * (a + b) for o, a, b in zip(odds, model.by_met[gate], model.by_node[node]))
            mixed = max(-12.0, min(12.0, mixed))
            place = (mixed + 12) * 32 / 24
            low = min(int(place), 31)
            refined = model.refined[gate, low] * (1 - place + low) + model.refined[gate, low + 1] * (place - low)
            one = 0.5 / (1 + math.exp(-mixed)) + 0.5 * refined
            total += math.log(one if bit else 1 - one)
    keys = next(mixing.grouped([doc]))[0]
    assert math.isclose(model.log_probabilities(keys).sum(), total, rel_tol=1e-4)


@pytest.mark.parametrize("bits", [1, 4, 21])
def test_times_count_every_key_whatever_has_to_go(monkeypatch, bits):
    monkeypatch.setattr(mixing, "REMEMBERED", bits)
    rng = np.random.default_rng(bits)
    got: Counter = Counter()

    def flush(keys, times):
        for k, n in zip(keys.tolist(), times.tolist()):
            got[k] += n

    times, want = mixing.Times(flush), Counter()
    for _ in range(20):
        keys = rng.zipf(1.3, 500).astype(np.uint64)
        want.update(keys.tolist())
        times.add(keys)
    times.close()
    assert got == want


def test_remembered_logs_are_the_computed_ones(trained, monkeypatch):
    docs, code, model = trained
    monkeypatch.setattr(mixing, "REMEMBERED", 6)
    fresh = Model(code, model.odds, model.met, model.by_met, model.by_node, model.refined)
    for keys, _ in mixing.grouped(docs[:6], 1000):
        assert (fresh.remembered_logs(keys) == model.log_probabilities(keys)).all()


def test_token_hashes_tell_tokens_apart():
    long = [b"a" * n for n in range(1, 30)] + [b"b" * 255, b"b" * 256, b"b" * 257, b"b" * 1000, b"x\0", b"x", b"x\0\0"]
    docs = [b" ".join([*long, b"\n"]), b"\n", b"x \n", b" ".join([*long[::-1], b"\n"])]
    hashes, lengths = mixing.token_hashes(docs)
    assert lengths.tolist() == [len(long) + 1, 1, 2, len(long) + 1]
    first, last = hashes[: len(long)], hashes[-len(long) - 1 : -1]
    assert len(set(hashes.tolist())) == len(long) + 1
    assert (first == last[::-1]).all()
    assert hashes[len(long)] == hashes[len(long) + 1] == mixing.END
    assert mixing.token_hashes([])[0].size == 0


def test_weights_learned_online_beat_those_at_the_start(trained):
    docs, code, model = trained
    start = Model(code, model.odds, model.met)
    fresh = [mixing.normalized(prose(np.random.default_rng(77), 2000).encode())]
    assert mixing.token_logs(model, fresh)[0].sum() > mixing.token_logs(start, fresh)[0].sum()


def test_pieces_and_groups_change_nothing(trained, monkeypatch):
    docs, _, model = trained
    some = [*docs[:3], b"\n", b"w" * 300 + b" \n", b"\n"]
    whole = mixing.token_logs(model, some)
    assert [len(x) for x in whole] == [d.count(b" ") + 1 for d in some]
    monkeypatch.setattr(mixing, "PIECE", 37)
    monkeypatch.setattr(mixing, "GROUP", 100)
    monkeypatch.setattr(mixing.grouped, "__defaults__", (100,))
    for a, b in zip(whole, mixing.token_logs(model, some)):
        assert np.allclose(a, b)


SCHEMA = "doc_id bigint, text string, fold int, score string, row string, block int, n_known int"


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(9)
    rows = [(i, prose(rng, int(rng.integers(1, 120))), i % 5) for i in range(120)]
    rows += [(200, None, 1), (201, "", 0), (202, " \n\t", 2), (None, "the an", 3), (5, rows[5][1], 0), (5, rows[5][1], 0), (203, "long " * 30_000 + "x" * 100_000, 1)]
    return [(*r, "s", "r", 1, 2) for r in rows]


def test_counts_and_base_equal_brute_force(spark, corpus):
    df = spark.createDataFrame(corpus, SCHEMA).repartition(5)
    lm = mixing.fit(df.where("fold <> 1").withColumn("tuning", F.col("fold") == 0), tuning="tuning")
    out = mixing.score(df, lm, block=4000)
    assert out.columns == ["doc_id", "fold", "row", "block", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    known = Counter(t for r in corpus if r[2] != 1 for t in tokens(r[1]))
    n, v = sum(known.values()), len(known)
    base = {t: math.log10((c + 0.5) / (n + 0.5 * (v + 1))) for t, c in known.items()}
    unknown = math.log10(0.5 / (n + 0.5 * (v + 1)))
    want = Counter((r[0], r[2], len(t), sum(w in known for w in t), n, round(sum(base.get(w, unknown) for w in t), 5)) for r in corpus for t in [tokens(r[1])])
    rows = out.collect()
    assert Counter((r["doc_id"], r["fold"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in rows) == want
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in rows)
    by_id = {r["doc_id"]: r["score"] for r in rows}
    assert by_id[200] == max(by_id.values())  # the end alone
    copies = {r["score"] for r in rows if r["doc_id"] == 5}
    assert len(copies) == 1


def test_blocks_do_not_matter(spark, corpus):
    df = spark.createDataFrame(corpus[:60], SCHEMA)
    lm = mixing.fit(df.where("fold <> 1"))
    one, many = ({r["doc_id"]: r["score"] for r in mixing.score(df, lm, block=b).collect()} for b in (1 << 30, 500))
    assert one.keys() == many.keys()
    assert all(math.isclose(one[k], many[k], rel_tol=1e-9) for k in one)


def test_nothing_to_learn_from_and_nothing_to_score(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    lm = mixing.fit(df.limit(0))
    assert lm.n_tokens == lm.n_distinct == 0
    rows = {r["doc_id"]: r for r in mixing.score(df, lm).collect()}
    assert rows[1]["n_tokens"] == 3 and rows[1]["n_known"] == 0 and rows[1]["base_score"] == 0.0
    assert rows[1]["score"] < rows[2]["score"] < 0
    assert mixing.score(df.limit(0), lm).collect() == []


def test_text_score_mixes_shares():
    by_bytes, counts = np.log(np.array([0.1, 0.001])), np.array([3, 0])
    base, score = mixing.text_score(by_bytes, counts, 10, 4)
    p, unknown = 3.5 / 12.5, 0.5 / 12.5
    assert math.isclose(base, math.log10(p * unknown))
    texts = [(0.1 * (1 - s) + p * s) * 0.001 * (1 - s + unknown * s) for s in mixing.SHARES]
    assert math.isclose(score, math.log10(sum(texts) / len(texts)))
