from __future__ import annotations

import re
import unicodedata
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.operators import vocab as vo
from corpusloom.operators.encode import decode, encode, encode_with
from corpusloom.operators.lookup import ids_to_tokens, joined_lookup, tokens_to_ids
from corpusloom.schemas import COMPAT_VOCAB, VOCABULARY

SLOW = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
PIECES = st.sampled_from(
    ["a", "b", "\n", "e\u0301", "\u00e9", "\u1112\u1161", "\U0001f600", "\ud55c", "<|im_start|>", "<|endoftext|>", "<|im_end|>", "<|", "|>", "\x00"]
)
TEXTS = st.lists(PIECES, max_size=30).map("".join)
VOCAB = {**COMPAT_VOCAB, "a": 5, "\n": 6, "\u00e9": 7, "\U0001f600": 8, "<": 9, "|": 10, "ab": 99}


def tokens_of(text, specials=("<|endoftext|>", "<|im_start|>")):
    text = unicodedata.normalize("NFC", text)
    pattern = "|".join([re.escape(s) for s in specials] + ["."])
    return re.findall(pattern, text, re.DOTALL)


def ids_of(text):
    return [VOCAB.get(t, 0) for t in tokens_of(text)]


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id int, text string").repartition(2)


def by_id(df, c):
    return [r[c] for r in sorted(df.collect(), key=lambda r: r["id"])]


@SLOW
@given(st.lists(TEXTS, min_size=1, max_size=12), st.one_of(st.none(), st.integers(0, 10)))
def test_encode_matches_plain_python(spark, values, cut):
    got = encode(texts(spark, values), VOCAB, count_col="n", max_tokens=cut)
    assert by_id(got, "ids") == [ids_of(t)[:cut] for t in values]
    assert by_id(got, "n") == [len(ids_of(t)) for t in values]


@SLOW
@given(st.lists(TEXTS, min_size=1, max_size=12), st.one_of(st.none(), st.integers(0, 10)))
def test_both_forms_agree_on_nfc_text(spark, values, cut):
    df = texts(spark, [unicodedata.normalize("NFC", t) for t in values])
    options = {"count_col": "n", "max_tokens": cut}
    arrow, native = encode(df, VOCAB, **options), encode(df, VOCAB, form="native", **options)
    assert by_id(arrow, "ids") == by_id(native, "ids")
    assert by_id(arrow, "n") == by_id(native, "n")


@SLOW
@given(st.lists(TEXTS, min_size=1, max_size=12))
def test_counts_match_plain_python(spark, values):
    want = Counter(t for text in values for t in tokens_of(text) if len(t) == 1)
    got = vo.token_counts(texts(spark, values))
    assert {r["token"]: r["n"] for r in got.collect()} == dict(want)
    composed = texts(spark, [unicodedata.normalize("NFC", t) for t in values])
    native = vo.token_counts(composed, form="native")
    assert {r["token"]: r["n"] for r in native.collect()} == dict(want)


@SLOW
@given(st.lists(TEXTS, min_size=1, max_size=12))
def test_decode_inverts_encode(spark, values):
    df = texts(spark, values)
    made = vo.reachable_entries(vo.corpus_vocab(df))
    back = decode(encode(df, made).drop("text"), made)
    assert by_id(back, "text") == [unicodedata.normalize("NFC", t) for t in values]


@SLOW
@given(st.lists(TEXTS, min_size=1, max_size=12))
def test_char_tokens(spark, values):
    composed = [unicodedata.normalize("NFC", t) for t in values]
    got = texts(spark, composed).withColumn("tokens", vo.char_tokens("text"))
    assert by_id(got, "tokens") == [tokens_of(t) for t in composed]


def test_long_texts_are_looked_up_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(vo, "CHUNK", 3)
    values = ["abcab" * 5, "ab<|im_start|>ba<|endoftext|>" * 4, "<|im_start|>" * 3, "a" * 7]
    for cut in (None, 0, 1, 4, 9):
        got = encode(texts(spark, values), VOCAB, count_col="n", max_tokens=cut)
        assert by_id(got, "ids") == [ids_of(t)[:cut] for t in values]
        assert by_id(got, "n") == [len(ids_of(t)) for t in values]
    counted = {r["token"]: r["n"] for r in vo.token_counts(texts(spark, values)).collect()}
    assert counted == {"a": 25, "b": 18, "c": 5}


def test_overlapping_and_neighbouring_specials(spark):
    specials = ("<|x|>", "|><|", "<|x|>y")
    values = ["<|x|>y", "<|x|><|x|>", "a|><|x|>", "|><|x|>", "x|>" * 3]
    ids = {s: 20 + i for i, s in enumerate(specials)}

    def want(text):
        longest_first = sorted(specials, key=len, reverse=True)
        return [ids.get(t, VOCAB.get(t, 0)) for t in tokens_of(text, longest_first)]

    for form in ("arrow", "native"):
        got = encode(texts(spark, values), {**VOCAB, **ids}, specials=specials, form=form)
        assert by_id(got, "ids") == [want(t) for t in values]


def test_specials_do_not_span_rows(spark):
    df = spark.createDataFrame([(0, "a<|im_"), (1, "start|>a")], "id int, text string").coalesce(1)
    assert by_id(encode(df, VOCAB), "ids") == [ids_of("a<|im_"), ids_of("start|>a")]


def test_too_many_specials(spark, monkeypatch):
    monkeypatch.setattr(vo, "MAX_SPECIALS", 2000)
    with pytest.raises(ValueError, match="specials"):
        encode(texts(spark, ["a"]), VOCAB, specials=[f"<{i}>" for i in range(3000)])


def test_automaton_equals_the_alternation(spark, monkeypatch):
    import random
    import re

    rng = random.Random(6)
    specials = tuple({"".join(rng.choice("ab<|é😀") for _ in range(rng.randrange(1, 7))) for _ in range(300)})
    pattern = re.compile("(?s)" + "|".join([re.escape(s) for s in sorted(specials, key=len, reverse=True)] + ["."]))
    values = ["".join(rng.choice("ab<|é😀 e\u0301") for _ in range(rng.randrange(0, 120))) for _ in range(200)] + [None, ""]
    ids = {s: 100 + i for i, s in enumerate(sorted(specials))}
    assert len(specials) > vo.AUTOMATON_FROM

    def tokens(text):
        import unicodedata

        return pattern.findall(unicodedata.normalize("NFC", text))

    vocabulary = {**VOCAB, **ids}
    want = [None if t is None else [vocabulary.get(x, 0) for x in tokens(t)] for t in values]
    got = encode(texts(spark, values), vocabulary, specials=specials, count_col="n")
    assert by_id(got, "ids") == want
    assert by_id(got, "n") == [None if w is None else len(w) for w in want]
    assert by_id(encode(texts(spark, values), vocabulary, specials=specials, max_tokens=5), "ids") == [None if w is None else w[:5] for w in want]
    counted = {r["token"]: r["n"] for r in vo.token_counts(texts(spark, values), specials=specials).collect()}
    plain = [x for t in values if t for x in tokens(t) if x not in ids]
    assert counted == {x: plain.count(x) for x in set(plain)}


def test_ten_thousand_specials_take_no_longer():
    import time

    text = "some ordinary words <|special 77|> and more " * 5_000
    spent = []
    for n in (100, 10_000):
        code = vo.coder([f"<|special {i}|>" for i in range(n)])
        code("")
        start = time.process_time()
        assert (code(text) >= vo.CODE_SPACE).sum() == 5_000
        spent.append(time.process_time() - start)
    assert spent[1] < 3 * spent[0] + 0.1


@pytest.mark.parametrize("n_specials", [2, vo.AUTOMATON_FROM + 1])
def test_encoding_gives_a_batch_group_by_group(n_specials):
    import tracemalloc

    import pyarrow as pa

    from corpusloom.operators.encode import _arrow_encoder

    specials = [f"<|{i}|>" for i in range(n_specials)]
    encoder = _arrow_encoder({**VOCAB, "<|1|>": 30}, specials, 0, None).func
    list(encoder(iter([pa.array(["a"])])))
    batch = pa.array(["a\u00e9z<|1|>" + "a" * 4_000] * 2_000 + [None, ""])
    tracemalloc.start()
    ends, n, most = [], 0, 0
    for got in encoder(iter([batch.slice(0, 0), batch])):
        ends += [(n + i, got[i].as_py()) for i in range(len(got)) if n + i in (0, 1_999, 2_000, 2_001)]
        n, most = n + len(got), max(most, len(got))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    text = {"ids": [5, 7, 0, 30] + [5] * 4_000, "n_tokens": 4_004}
    assert ends == [(0, text), (1_999, text), (2_000, {"ids": None, "n_tokens": None}), (2_001, {"ids": [], "n_tokens": 0})]
    assert n == 2_002 and most < 300
    assert peak < 24 << 20  # the ids alone have 32 MB


def test_null_empty_and_unknown(spark):
    got = encode(texts(spark, [None, "", "zz"]), VOCAB, unk_id=3, count_col="n")
    assert by_id(got, "ids") == [None, [], [3, 3]]
    assert by_id(got, "n") == [None, 0, 2]


def test_empty_vocabulary_and_no_specials(spark):
    df = texts(spark, ["<|im_start|>", "ab"])
    for form in ("arrow", "native"):
        got = encode(df, {}, specials=(), unk_id=7, form=form)
        assert by_id(got, "ids") == [[7] * 12, [7, 7]]


def test_decomposed_and_astral_are_one_token(spark):
    assert by_id(encode(texts(spark, ["e\u0301", "\U0001f600"]), VOCAB), "ids") == [[7], [8]]


def test_vocab_table_may_be_larger_than_its_reachable_part(spark):
    table = spark.createDataFrame(list(VOCAB.items()), "token string, id int")
    assert "ab" not in vo.reachable_entries(table)
    assert by_id(encode(texts(spark, ["ab"]), table), "ids") == [[5, 0]]


def test_user_tokenizer(spark):
    df = texts(spark, ["one two", None, ""])
    got = encode_with(df, lambda batch: [[len(w) for w in t.split()] for t in batch], count_col="n", max_tokens=1)
    assert by_id(got, "ids") == [[3], None, []]
    assert by_id(got, "n") == [2, None, 0]

    def load():
        return lambda batch: [[ord(t[0])] if t else [] for t in batch]

    assert by_id(encode_with(df, setup=load), "ids") == [[111], None, []]
    with pytest.raises(ValueError):
        encode_with(df)


def test_user_tokenizer_gets_texts_in_groups(spark, monkeypatch):
    from corpusloom.operators import encode as module

    monkeypatch.setattr(module, "GROUP_CHARS", 10)
    values = [None if i % 7 == 3 else "ab " * (i % 6) for i in range(60)] + [None, ""]
    df = texts(spark, values).coalesce(1)

    def tokenizer(batch):
        assert sum(map(len, batch)) < 10 + 15
        return [[len(w) for w in t.split()] for t in batch]

    got = encode_with(df, tokenizer, count_col="n", max_tokens=3)
    assert by_id(got, "ids") == [None if t is None else [2] * min(len(t) // 3, 3) for t in values]
    assert by_id(got, "n") == [None if t is None else len(t) // 3 for t in values]


def test_decode_skips_and_falls_back(spark):
    df = spark.createDataFrame([(0, [1, 5, 77, 0, 8]), (1, []), (2, None)], "id int, ids array<int>")
    assert by_id(decode(df, VOCAB), "text") == ["<|im_start|>a<|endoftext|><|endoftext|>\U0001f600", "", None]
    assert by_id(decode(df, VOCAB, skip_ids=(0, 1)), "text") == ["a<|endoftext|>\U0001f600", "", None]


def test_join_form_equals_local_form(spark):
    rows = [(0, ["a"] * 50 + ["b", "\n"]), (1, []), (2, None), (3, ["<|im_start|>", None])]
    df = spark.createDataFrame(rows, "id int, tokens array<string>")
    table = spark.createDataFrame(list(VOCAB.items()), "token string, id int")
    local = tokens_to_ids(df, table)
    joined = tokens_to_ids(df, table, max_local=0)
    assert by_id(local, "ids") == by_id(joined, "ids") == [[5] * 50 + [0, 6], [], None, [1, 0]]
    back_local = ids_to_tokens(joined.drop("tokens"), table)
    back_joined = ids_to_tokens(joined.drop("tokens"), table, max_local=0)
    assert by_id(back_local, "tokens") == by_id(back_joined, "tokens")


def test_join_form_with_hot_and_unknown_items(spark, plan_text):
    rows = [(i, ["hot"] * 20 + [f"t{i % 50}", f"unknown{i}"], "x") for i in range(400)] + [(400, [], "y"), (401, None, "z"), (402, [None], "w")]
    df = spark.createDataFrame(rows, "id int, tokens array<string>, ids string").repartition(7)
    table = spark.createDataFrame([("hot", 7)] + [(f"t{i}", 100 + i) for i in range(50)], "token string, id int")
    out = joined_lookup(df, table, "tokens", "ids", "token", "id", 0)
    got = {r["id"]: r["ids"] for r in out.collect()}
    assert got == {i: [7] * 20 + [100 + i % 50, 0] for i in range(400)} | {400: [], 401: None, 402: [0]}
    assert joined_lookup(df.limit(0), table, "tokens", "ids", "token", "id", 0).collect() == []
    assert joined_lookup(df, table.limit(0), "tokens", "ids", "token", "id", 0).count() == 403


def test_sparse_ids_take_the_join_form(spark):
    df = spark.createDataFrame([(0, [5, 2_000_000_000])], "id int, ids array<int>")
    got = ids_to_tokens(df, {"a": 5, "far": 2_000_000_000})
    assert by_id(got, "tokens") == [["a", "far"]]


def test_corpus_vocab_order_and_bounds(spark):
    df = texts(spark, ["bbb aa", "ac\u0301", "<|im_start|>zz"])
    rows = [tuple(r) for r in vo.corpus_vocab(df).orderBy("id").collect()]
    assert rows == [*COMPAT_VOCAB.items(), ("a", 5), ("b", 6), ("z", 7), (" ", 8), ("\u0107", 9)]
    bounded = vo.corpus_vocab(df, max_size=6).orderBy("id")
    assert [r["id"] for r in bounded.collect()] == list(range(6))
    frequent = vo.corpus_vocab(df, min_count=2, reserved={})
    assert [tuple(r) for r in frequent.orderBy("id").collect()] == [("a", 0), ("b", 1), ("z", 2)]


def test_vocabulary_file_and_inversion(spark, tmp_path):
    df = texts(spark, ['"\\\n\u00e9\U0001f600\ud55c'])
    made = vo.corpus_vocab(df)
    (path,) = vo.save_vocabulary(made, str(tmp_path / "new"), "corpus")
    assert path.endswith("/new/corpus-vocab.json")
    assert {tuple(r) for r in vo.load_vocabulary(spark, path).collect()} == {tuple(r) for r in made.collect()}
    assert vo.save_vocabulary(made, str(tmp_path))[0].endswith("/vocab.json")
    assert vo.invert(vo.compat_vocab(spark)).columns == ["id", "token"]
    inverse = vo.as_map(vo.compat_vocab(spark)).select(vo.invert_map("vocab").alias("m")).first()["m"]
    assert inverse == {v: k for k, v in COMPAT_VOCAB.items()}


def test_counting_shuffles_counts_not_characters(spark, plan_text):
    plan = plan_text(vo.token_counts(texts(spark, ["aaa"])))
    assert "MapInArrow" in plan and "Generate" not in plan


def test_reserved_entries_need_no_python_workers(spark, plan_text):
    made = vo.corpus_vocab(spark.range(3).select(F.lit("abb").alias("text")), reserved={"<|x|>": 0, "é": 3})
    for table in (made, vo.invert(made), vo.compat_vocab(spark)):
        assert "ExistingRDD" not in plan_text(table)
    assert {r["token"]: r["id"] for r in made.collect()} == {"<|x|>": 0, "é": 3, "b": 4, "a": 5}
    assert made.schema.simpleString() == "struct<token:string,id:int>"
    assert vo.compat_vocab(spark).schema == VOCABULARY


def test_lookup_runs_without_python(spark, plan_text):
    df = spark.createDataFrame([(0, [5])], "id int, ids array<int>")
    assert "EvalPython" not in plan_text(decode(df, VOCAB))
    assert "EvalPython" not in plan_text(encode(texts(spark, ["a"]).select(F.col("text")), VOCAB, form="native"))
