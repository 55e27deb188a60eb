"""Best segmentations against all segmentations of short texts."""

from __future__ import annotations

import random

import pytest

from corpusloom.operators import segment as module
from corpusloom.operators.segment import Segmenter, segment


def all_ways(text: str, pieces: dict[str, tuple[int, float]], unk: int, unknown: float):
    """Every segmentation with its score."""
    if not text:
        yield 0.0, []
        return
    for n in range(1, len(text) + 1):
        if text[:n] in pieces:
            piece = pieces[text[:n]]
        elif n == 1:
            piece = (unk, unknown)
        else:
            continue
        for score, rest in all_ways(text[n:], pieces, unk, unknown):
            yield score + piece[1], [piece[0], *rest]


def made_pieces(rng, letters: str, n: int) -> dict[str, tuple[int, float]]:
    found = {"".join(rng.choice(letters) for _ in range(rng.randrange(1, 5))) for _ in range(n)}
    # Distinct powers: no two segmentations have one sum.
    return {p: (i + 1, -1 - rng.random() * 8) for i, p in enumerate(sorted(found))}


@pytest.mark.parametrize("letters", ["abc", "ab ", "aé😀", "a b"])
def test_best_of_all_segmentations(letters):
    rng = random.Random(letters)
    for _ in range(40):
        pieces = made_pieces(rng, letters, rng.randrange(0, 14))
        own = Segmenter({p.replace(" ", "▁"): v for p, v in pieces.items()})
        texts = ["".join(rng.choice(letters + "z") for _ in range(rng.randrange(0, 11))) for _ in range(20)]
        for text, ids in zip(texts, own.encode(texts)):
            ways = list(all_ways(text, pieces, 0, own.unknown))
            best = max(score for score, _ in ways)
            assert any(abs(score - best) < 1e-9 and way == ids for score, way in ways), (text, ids)


def test_words_and_whole_texts_give_the_same(monkeypatch):
    rng = random.Random(3)
    pieces = {p.replace(" ", "▁"): v for p, v in made_pieces(rng, "ab", 12).items()} | {"▁a": (90, -2.0), "▁ab": (91, -2.5), "▁": (92, -3.0)}
    texts = ["".join(rng.choice("ab  z") for _ in range(rng.randrange(0, 200))) for _ in range(50)]
    own = Segmenter(pieces)
    assert own.by_word
    by_word = own.encode(texts)
    own.by_word = False
    assert own.encode(texts) == by_word
    monkeypatch.setattr(module, "GROUP_CHARS", 50)
    assert own.encode(texts) == by_word


def test_words_of_long_texts_in_groups(monkeypatch):
    rng = random.Random(5)
    pieces = {p.replace(" ", "▁"): v for p, v in made_pieces(rng, "ab", 12).items()} | {"▁a": (90, -2.0), "▁ab": (91, -2.5), "▁": (92, -3.0)}
    texts = [" ".join("".join(rng.choice("abz") for _ in range(rng.randrange(0, 9))) for _ in range(n)) for n in (900, 0, 1, 300, 700)]
    texts += ["a" * 200 + " b", " " * 120, ""]
    own = Segmenter(pieces)
    whole = own.encode(texts)
    seen, best = [], own._best
    monkeypatch.setattr(own, "_best", lambda codes, bounds: seen.append(len(codes)) or best(codes, bounds))
    monkeypatch.setattr(module, "GROUP_CHARS", 50)
    assert own.encode(texts) == whole
    assert len(seen) > 100 and sorted(seen)[-2] < 100 and max(seen) < 300  # a word is not cut
    assert sum(seen) == sum(map(len, texts))


def test_ties_take_the_longest_last_piece():
    own = Segmenter({"a": (1, -1.0), "b": (2, -1.0), "ab": (3, -2.0)})
    assert own.encode(["ab", "abab"]) == [[3], [3, 3]]


def test_long_texts_and_nothing():
    own = Segmenter({"ab": (1, -1.0), "a": (2, -3.0)})
    assert own.encode([]) == [] and own.encode(["", "", "ab"]) == [[], [], [1]]
    assert own.encode(["ab" * 100_000]) == [[1] * 100_000]
    assert Segmenter({}).encode(["xy"]) == [[0, 0]]


def test_segment_of_a_table(spark, plan_text):
    pieces = spark.createDataFrame([("▁the", 5, -1.0), ("the", 6, -1.5), ("t", 7, -4.0), ("h", 8, -4.0), ("e", 9, -4.0), ("é", 10, -4.0), ("▁", 11, -3.0)], "token string, id int, score double")
    df = spark.createDataFrame([(1, "the the"), (2, None), (3, ""), (4, "thé"), (5, "thx the")], "k int, text string")
    out = segment(df, pieces, count_col="n", max_tokens=3)
    got = {r["k"]: (r["ids"], r["n"]) for r in out.collect()}
    assert got == {1: ([6, 5], 2), 2: (None, None), 3: ([], 0), 4: ([7, 8, 10], 3), 5: ([7, 8, 0], 4)}
    assert out.columns == ["k", "text", "ids", "n"]
    assert "Exchange" not in plan_text(out)
    with pytest.raises(ValueError, match="twice"):
        segment(df, pieces.union(pieces.limit(1)))


def test_query_over_scored_pieces(spark):
    from pathlib import Path

    from corpusloom.queries import q_encode_pieces, scored_pieces

    tables = "/root/testdata/sf0.001"
    if not Path(tables).is_dir():
        pytest.skip("no test tables")
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    pieces = {r["token"]: (r["id"], r["score"]) for r in scored_pieces(docs).collect()}
    own = Segmenter(pieces)
    assert own.by_word
    by_id = {i: p.replace("▁", " ") for p, (i, _) in pieces.items()}
    rows = {r["doc_id"]: r for r in q_encode_pieces(spark, tables).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert rows.keys() == texts.keys()
    for doc_id, text in texts.items():
        ids = own.encode([text])[0]
        assert "".join(by_id[i] for i in ids) == text
        assert rows[doc_id]["n_ids"] == len(ids) and rows[doc_id]["sum_ids"] == sum(ids)
    assert sum(r["n_ids"] for r in rows.values()) < 0.7 * sum(map(len, texts.values()))
