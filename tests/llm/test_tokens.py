"""Byte-level BPE and packing against the tokenizers library and brute force."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from corpusloom.llm import bpe, packing

BYTE = bpe.tokenizer_path("byte_bpe_50k.json")
WORD = bpe.tokenizer_path("word_bpe_49k.json")
TEXTS = [
    "",
    "a  b",
    " lead",
    "trail ",
    "x\n\ny",
    "it's we're 'S 's",
    " 's <|endoftext|> x<|endoftext|>y",
    "<|startoftext|> HI <|ENDOFTEXT|><|endoftext|>",
    "éÀ ÉÑ Ǆ İ ΣΑΣ ὈΔΥΣΣΕΎΣ",
    "é ö. ́x",
    "a\x1cb\x1d c",
    " x y　z",
    "日本語 テキスト。 😀😀 ok",
    "aaaaaaaaaaaa aaaa aaa",
    "\t\tx \r\n y",
    "a.b, c., d.. e,, ...,. 1. É. A.",
    "don't. DON'T, I'LL'd ß. ﬁ, ²³½ ٣٤",
    "x" * 3000 + " y",
    " \n \n x  \n",
    "a​b. ​",
]


def random_texts(n=300, seed=5):
    r = random.Random(seed)
    letters = "aaabcdeé.,' \n  ABC12<|>ßñ\t"
    return ["".join(r.choice(letters) for _ in range(r.randrange(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("path,make", [(BYTE, bpe.Encoder), (WORD, packing.WordIds)])
def test_ids_equal_the_library(path, make):
    library = Tokenizer.from_file(path)
    rows = TEXTS + random_texts()
    got = make(path).encode_batch(rows)
    for text, ids in zip(rows, got):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_marks_behind_every_letter():
    library = Tokenizer.from_file(WORD)
    letters = [chr(c) for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isalpha()]
    own = packing.WordIds(WORD)
    for at in range(0, len(letters), 20_000):
        rows = [f"{c}. a{c}, {c}b." for c in letters[at : at + 20_000]]
        want = library.encode_batch(rows, add_special_tokens=False)
        for text, ids, found in zip(rows, own.encode_batch(rows), want):
            assert np.frombuffer(ids, "<u4").tolist() == found.ids, repr(text)
    r = random.Random(8)
    mixed = ["İ", "ǅ", "ß", "Σ", "é", "e\u0301", "ﬁ", "a", "Z", ".", ",", " ", "'", "\u0307", "ा", "क"]
    rows = ["".join(r.choice(mixed) for _ in range(r.randrange(1, 12))) for _ in range(20_000)]
    for text, ids in zip(rows, own.encode_batch(rows)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_loose_sequences_of_all_partitions_are_packed_again(spark):
    r = np.random.default_rng(5)
    lengths = r.integers(1, 2048, 3000)
    found = spark.createDataFrame([(i, int(n), "x") for i, n in enumerate(lengths)], "doc_id bigint, length bigint, _part string")
    out = packing.pack(found, partition_pieces=100).toPandas()
    assert list(out.columns) == ["doc_id", "length", "_part", "sequence_id", "offset"]
    assert sorted(out["length"]) == sorted(lengths)
    for _, rows in out.groupby("sequence_id"):
        rows = rows.sort_values("offset")
        assert rows["offset"].tolist() == [0, *np.cumsum(rows["length"])[:-1]] and rows["length"].sum() <= 2048
    bound = -(-lengths.sum() // 2048)
    apart = sum(packing.place(np.sort(part)[::-1])[0].max() + 1 for part in np.array_split(lengths, 30))
    assert bound <= out["sequence_id"].nunique() < apart


def test_recent_entries_are_bounded_and_stay_right(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    bpe.worker_cache(f"bpe:{BYTE}").clear()
    encoder, library = bpe.Encoder(BYTE), Tokenizer.from_file(BYTE)
    for text in random_texts(40, 9) * 2:
        assert np.frombuffer(encoder.encode_batch([text])[0], "<u4").tolist() == library.encode(text).ids
    bpe.worker_cache(f"bpe:{BYTE}").clear()


def test_op8_round_trip(spark, tmp_path):
    rows = [(i, t, 7) for i, t in enumerate(TEXTS)] + [(99, None, 1), (None, "null id", 2), (0, TEXTS[0], 3)]
    spark.createDataFrame(rows, "doc_id bigint, text string, ids int").write.parquet(f"{tmp_path}/documents.parquet")
    library = Tokenizer.from_file(BYTE)
    got = bpe.op8_bpe(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    texts = dict((i, t) for i, t, _ in rows)
    for r in got:
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_encode_and_decode_keep_other_columns(spark):
    df = spark.createDataFrame([(1, "some text", "x"), (2, None, "y")], "k int, text string, decoded string")
    out = bpe.decode(bpe.encode(df, BYTE), BYTE).collect()
    assert [(r["k"], r["decoded"]) for r in out] == [(1, "some text"), (2, "")]
    assert bpe.encode(df.limit(0), BYTE).collect() == []


def slow_place(lengths, size):
    """The rule itself, with the sum of squares counted anew for every choice."""
    gaps = []
    for n in lengths:
        best = None
        for g in sorted({g for g in gaps if g >= n}) + [size]:
            rest = list(gaps)
            if g != size or size in rest:
                rest.remove(g)
            if g - n:
                rest.append(g - n)
            cost = sum(rest.count(x) ** 2 for x in set(rest))
            if best is None or cost < best[0]:
                best = (cost, rest)
        gaps = best[1]
    return gaps


def test_place_follows_the_sum_of_squares_rule():
    r = random.Random(3)
    for size in (10, 17):
        lengths = sorted((r.randrange(1, size) for _ in range(120)), reverse=True)
        bins, offsets = packing.place(np.array(lengths), size)
        filled = {b: sum(n for n, x in zip(lengths, bins) if x == b) for b in set(bins.tolist())}
        assert max(filled.values()) <= size
        assert sorted(size - v for v in filled.values() if v < size) == sorted(slow_place(lengths, size))
        for b in filled:
            spans = sorted((o, n) for o, n, x in zip(offsets, lengths, bins) if x == b)
            assert [o for o, _ in spans] == np.cumsum([0] + [n for _, n in spans])[:-1].tolist()


def test_a_few_thousand_pieces_are_one_packing(spark):
    r = random.Random(0)
    lengths = [min(2047, 1 + int(r.lognormvariate(5.5, 1))) for _ in range(4000)]
    found = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id bigint, length bigint")
    got = packing.pack(found).select("sequence_id").distinct().count()
    bins, _ = packing.place(np.array(sorted(lengths, reverse=True)))
    assert -(-sum(lengths) // packing.SIZE) <= got <= bins.max() + 1
    assert got <= len(set(bins.tolist()))


def test_pieces_and_packing(spark):
    long = "word and other words " * 2500
    rows = [(1, long), (2, None), (3, ""), (4, "short"), (4, "short"), (None, "no id")] + [(10 + i, "some text " * (i % 40)) for i in range(300)]
    df = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id bigint, text string, piece int")
    got = packing.pack_documents(df, WORD).toPandas()
    library = Tokenizer.from_file(WORD)
    want = []
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            own = ids[at : at + 2048]
            want.append((i, k, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    made = [(None if i != i else int(i), *map(int, x)) for i, *x in got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False)]
    assert sorted(made, key=str) == sorted(want, key=str)
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g["length"].sum() <= 2048
        assert g["offset"].tolist() == [0, *g["length"].cumsum().tolist()[:-1]]
    total = got["length"].sum()
    assert got["sequence_id"].nunique() <= -(-total // 2048) + 1
    assert packing.pack_documents(df.limit(0), WORD).collect() == []
