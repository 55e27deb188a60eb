"""One query per operator over the shared Parquet tables; each is (spark, directory) -> DataFrame."""

from __future__ import annotations

import math
from string import ascii_lowercase

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions import sequences as seq
from corpusloom.functions.metrics import FLOAT_METRICS
from corpusloom.functions.text import (
    FRAME_HEAD,
    FRAME_MIDDLE,
    FRAME_TAIL,
    is_blank,
    is_non_empty,
    nfc,
    render_instruction_input,
    render_prompt_response,
    render_system_user,
    timestamp_key,
    uri_bucket,
    uri_key,
)
from corpusloom.operators import conversations, stats, vocab
from corpusloom.operators.batches import map_batches
from corpusloom.operators.encode import decode, encode, encode_pair, encode_with
from corpusloom.operators.length_sketches import exact_quantiles, update_sketches
from corpusloom.operators.lookup import ids_to_tokens, tokens_to_ids
from corpusloom.operators.model_inputs import (
    assert_rectangular,
    close_sequences,
    pad_and_label,
    prepare,
    sequences,
)
from corpusloom.operators.responses import (
    as_results,
    batch_responses,
    case_inputs,
    count_cases,
    last_content,
)
from corpusloom.operators.segment import segment
from corpusloom.plans.batch_plan import BatchShape, batch_plan, plan_summary
from corpusloom.plans.numbering import number_keys
from corpusloom.plans.permuted import plan_rows, resume, total_steps
from corpusloom.plans.shards import export_shards, read_shard
from corpusloom.schemas import COMPAT_VOCAB, DEFAULT_MAX_LENGTH, RESULT
from corpusloom.sinks.scratch import scratch_path
from corpusloom.sinks.writers import (
    write_cases,
    write_corpus,
    write_model_inputs,
    write_results,
    write_summary,
)
from corpusloom.sources.cases import read_cases
from corpusloom.sources.corpora import corpus_columns, read_corpus
from corpusloom.sources.logs import read_logs
from corpusloom.sources.spread import spread
from corpusloom.streaming.loss_metrics import extract_metrics, start_metric_stream
from corpusloom.streaming.responses import read_journal, start_responses

STEP_SHAPE = BatchShape(micro_batch=4, accumulation=8, world_size=8, max_steps=10)
EPOCH_SHAPE = BatchShape(micro_batch=4, accumulation=8, world_size=8, epochs=3)
KEY = ("conv_id", "turn")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def digest(ids: str) -> Column:
    """md5 of an id array written as JSON."""
    return F.md5(F.to_json(ids))


# Corpora of the three layouts, made from the conversations table.


def prompt_response_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.pair_turns(table(spark, sf_dir, "conversations"), with_system=False)


def instruction_input_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs that are empty, blank in two ways, or the system text, by turn number."""
    pairs = conversations.pair_turns(table(spark, sf_dir, "conversations"))
    form = F.col("turn") % 8
    made_input = (
        F.when(form == 0, F.lit(""))
        .when(form == 2, F.lit(" \t"))
        .when(form == 4, F.lit("\u3000"))
        .otherwise(F.coalesce("system_prompt", F.lit("")))
    )
    return pairs.select(
        *KEY, F.col("prompt").alias("instruction"), made_input.alias("input"), F.col("response").alias("output")
    )


def system_user_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = conversations.pair_turns(table(spark, sf_dir, "conversations"))
    return pairs.select(
        *KEY, "system_prompt", F.col("prompt").alias("user_prompt"), F.col("response").alias("answer")
    )


def marked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with declared specials around and inside the text."""
    text = F.concat(
        F.lit("<|im_start|>"), "source", F.lit("\n"), "text", F.lit("<|endoftext|><|im_end|>"), "lang"
    )
    return documents(spark, sf_dir).select("doc_id", "lang", text.alias("text"))


def staged_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.staged_corpus(
        {
            "prompt_response": prompt_response_corpus(spark, sf_dir).select(
                *KEY, render_prompt_response().alias("text")
            ),
            "instruction_input": instruction_input_corpus(spark, sf_dir).select(
                *KEY, render_instruction_input().alias("text")
            ),
            "system_user": system_user_corpus(spark, sf_dir).select(
                *KEY, render_system_user().alias("text")
            ),
        }
    )


def conversation_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as test cases, numbered in the order of conv_id; the parts of one share its number."""
    turns = table(spark, sf_dir, "conversations")
    numbers = number_keys(turns.select("conv_id").distinct(), ["conv_id"], "test_case")
    numbers = numbers.select("conv_id", F.col("test_case").cast("int").alias("test_case"))
    return conversations.assemble_messages(turns).join(numbers, "conv_id").select("test_case", "part", "messages")


def message_rows(parts: DataFrame, key: str) -> DataFrame:
    """One row per message with its position in the whole conversation, from the sizes of the parts before."""
    before = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum(F.size("messages")).over(before), F.lit(0))
    placed = parts.withColumn("first", first)
    rows = placed.select(key, "first", F.posexplode("messages").alias("at", "message"))
    return rows.select(
        key, (F.col("first") + F.col("at") + 1).cast("long").alias("position"), "message.role", "message.content"
    )


# Rendering


def q_render_prompt_response(spark, sf_dir):
    return prompt_response_corpus(spark, sf_dir).select(*KEY, render_prompt_response().alias("text"))


def q_render_instruction_input(spark, sf_dir):
    return instruction_input_corpus(spark, sf_dir).select(*KEY, render_instruction_input().alias("text"))


def q_render_system_user(spark, sf_dir):
    return system_user_corpus(spark, sf_dir).select(*KEY, render_system_user().alias("text"))


def q_render_system_only(spark, sf_dir):
    """Empty user prompts: the system prompt stands alone; both may be empty."""
    corpus = system_user_corpus(spark, sf_dir).withColumn(
        "user_prompt", F.when(F.col("turn") % 4 < 2, F.col("user_prompt"))
    )
    return corpus.select(*KEY, render_system_user().alias("text"))


def q_blank_predicate(spark, sf_dir):
    return instruction_input_corpus(spark, sf_dir).select(
        *KEY, is_blank("input").alias("blank"), is_non_empty("input").alias("non_empty")
    )


def q_stage_union(spark, sf_dir):
    return staged_texts(spark, sf_dir)


# Conversations


def q_turn_pairs(spark, sf_dir):
    return conversations.pair_turns(table(spark, sf_dir, "conversations"))


def q_message_assembly(spark, sf_dir):
    return message_rows(conversations.assemble_messages(table(spark, sf_dir, "conversations")), "conv_id")


def q_last_message(spark, sf_dir):
    return conversations.last_messages(table(spark, sf_dir, "conversations"))


def q_conversation_count(spark, sf_dir):
    return conversations.count_conversations(table(spark, sf_dir, "conversations"))


# Tokens and vocabularies


def q_nfc_text(spark, sf_dir):
    """Texts taken apart (e with a combining accent behind each e) and composed again."""
    loose = F.replace("text", F.lit("e"), F.lit("e\u0301"))
    composed = documents(spark, sf_dir).select("doc_id", nfc(loose).alias("text"))
    return composed.select("doc_id", F.length("text").alias("chars"), F.md5("text").alias("digest"))


def q_char_tokens(spark, sf_dir):
    tokens = marked_documents(spark, sf_dir).select("doc_id", vocab.char_tokens("text").alias("tokens"))
    return tokens.select("doc_id", F.size("tokens").alias("n_tokens"), F.md5(F.array_join("tokens", ",")).alias("digest"))


def q_token_counts(spark, sf_dir):
    return vocab.token_counts(marked_documents(spark, sf_dir))


def q_token_counts_native(spark, sf_dir):
    return vocab.token_counts(marked_documents(spark, sf_dir), form="native")


def q_corpus_vocab(spark, sf_dir):
    return vocab.corpus_vocab(documents(spark, sf_dir))


def q_corpus_vocab_bounded(spark, sf_dir):
    return vocab.corpus_vocab(documents(spark, sf_dir), min_count=10, max_size=40)


def q_vocab_inversion(spark, sf_dir):
    return vocab.invert(vocab.corpus_vocab(documents(spark, sf_dir)))


def q_vocab_export(spark, sf_dir):
    made = vocab.corpus_vocab(documents(spark, sf_dir))
    (path,) = vocab.save_vocabulary(made, scratch_path(spark, "vocab"), "corpus")
    return vocab.load_vocabulary(spark, path)


def _encoded_digest(encoded: DataFrame, *keys: str) -> DataFrame:
    total = F.aggregate("ids", F.lit(0).cast("long"), lambda acc, i: acc + i)
    return encoded.select(
        *keys, F.size("ids").alias("n_ids"), total.alias("sum_ids"), digest("ids").alias("digest")
    )


def q_encode_corpus_vocab(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    encoded = encode(docs, vocab.corpus_vocab(docs))
    return _encoded_digest(encoded.withColumn("ids", seq.append_eos("ids", 0)), "doc_id")


def q_encode_corpus_vocab_native(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    encoded = encode(docs, vocab.corpus_vocab(docs), form="native")
    return _encoded_digest(encoded.withColumn("ids", seq.append_eos("ids", 0)), "doc_id")


def q_encode_compat_vocab(spark, sf_dir):
    encoded = encode(marked_documents(spark, sf_dir), COMPAT_VOCAB)
    return _encoded_digest(encoded.withColumn("ids", seq.append_eos("ids", 0)), "doc_id")


def q_encode_pair(spark, sf_dir):
    corpus = prompt_response_corpus(spark, sf_dir)
    made = vocab.corpus_vocab(table(spark, sf_dir, "conversations"))
    return _encoded_digest(encode_pair(corpus, made, "prompt", "response"), *KEY)


def _word_lengths(texts: list[str]) -> list[list[int]]:
    return [[len(word) for word in t.split(" ")] for t in texts]


def q_encode_with_tokenizer(spark, sf_dir):
    """A user tokenizer: one id per word, its length."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return _encoded_digest(encode_with(docs, _word_lengths), "doc_id")


#: All pairs of letters, more specials than an alternation is used for.
LETTER_PAIRS = {a + b: 1 + 26 * i + k for i, a in enumerate(ascii_lowercase) for k, b in enumerate(ascii_lowercase)}


def q_encode_many_specials(spark, sf_dir):
    """Hundreds of specials that overlap each other, found by one automaton; all else is unknown."""
    encoded = encode(documents(spark, sf_dir), LETTER_PAIRS, specials=LETTER_PAIRS)
    return _encoded_digest(encoded, "doc_id")


MOST_PIECES = 2_000


def scored_pieces(docs: DataFrame) -> DataFrame:
    """(token, id, score): all characters and the most frequent words with the blank before them, scored by their share of all."""
    words = docs.select(F.explode(F.split("text", " ")).alias("w")).where("w <> ''").groupBy("w").agg(F.count("*").alias("n"))
    frequent = words.orderBy(F.desc("n"), "w").limit(MOST_PIECES).select(F.concat(F.lit("▁"), "w").alias("token"), "n")
    chars = vocab.token_counts(docs, specials=()).select(F.when(F.col("token") == " ", "▁").otherwise(F.col("token")).alias("token"), "n")
    pieces = frequent.unionByName(chars).groupBy("token").agg(F.max("n").alias("n"))
    # As many rows as there are code points and frequent words at most.
    score = F.log(F.col("n") / F.sum("n").over(Window.partitionBy()))
    return pieces.select("token", F.row_number().over(Window.orderBy(F.desc("n"), "token")).alias("id"), score.alias("score"))


def q_encode_pieces(spark, sf_dir):
    """Whole documents by their best pieces."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return _encoded_digest(segment(docs, scored_pieces(docs)), "doc_id")


def q_token_id_join(spark, sf_dir):
    """Token lookup in its join form, for vocabularies of any size."""
    turns = table(spark, sf_dir, "conversations")
    tokens = turns.select(F.concat_ws("-", *KEY).alias("key"), vocab.char_tokens("text").alias("tokens"))
    ids = tokens_to_ids(tokens, vocab.corpus_vocab(turns), max_local=0)
    return _encoded_digest(ids, "key")


def q_id_token_join(spark, sf_dir):
    """Id lookup in its join form; ids from 40 on are unknown to the bounded vocabulary."""
    turns = table(spark, sf_dir, "conversations")
    encoded = encode(turns.select(F.concat_ws("-", *KEY).alias("key"), "text"), vocab.corpus_vocab(turns))
    bounded = vocab.corpus_vocab(turns, max_size=40)
    tokens = ids_to_tokens(encoded, bounded, max_local=0)
    return tokens.select("key", F.md5(F.array_join("tokens", "")).alias("digest"))


def q_decode_roundtrip(spark, sf_dir):
    """Encode and decode whole texts."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    made = vocab.reachable_entries(vocab.corpus_vocab(docs))
    encoded = encode(docs, made).drop("text")
    return decode(encoded, made).select("doc_id", "text")


def q_decode_skip_special(spark, sf_dir):
    docs = marked_documents(spark, sf_dir)
    made = vocab.reachable_entries(vocab.corpus_vocab(docs))
    decoded = decode(encode(docs, made).drop("text"), made, skip_ids=(0, 1))
    return decoded.select("doc_id", F.md5("text").alias("digest"))


# Model inputs


def _closed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode(
        marked_documents(spark, sf_dir),
        COMPAT_VOCAB,
        count_col="n_tokens",
        max_tokens=DEFAULT_MAX_LENGTH - 1,
    )
    return close_sequences(encoded)


def q_pad_truncate(spark, sf_dir):
    closed = _closed_documents(spark, sf_dir)
    padded = closed.select(
        "doc_id",
        "n_tokens",
        seq.left_pad("ids", DEFAULT_MAX_LENGTH, 0).alias("input_ids"),
        seq.attention_mask("ids", DEFAULT_MAX_LENGTH).alias("attention_mask"),
    )
    n_real = seq.real_length("attention_mask")
    return padded.select(
        "doc_id",
        F.size("input_ids").alias("size"),
        n_real.alias("n_real"),
        (F.size("attention_mask") - n_real).alias("n_pad"),
        (F.col("n_tokens") >= DEFAULT_MAX_LENGTH).alias("truncated"),
    )


def q_label_mask(spark, sf_dir):
    """With the compatibility vocabulary only <|im_start|> stays supervised."""
    inputs = pad_and_label(_closed_documents(spark, sf_dir), keep=["doc_id"])
    kept = F.size(F.array_remove("labels", F.lit(-100)))
    return inputs.select(
        "doc_id",
        kept.alias("supervised"),
        (F.size("labels") - kept).alias("masked"),
        digest("labels").alias("digest"),
    )


def _input_digests(inputs: DataFrame, *keys: str) -> DataFrame:
    return inputs.select(
        *keys,
        digest("input_ids").alias("input_ids"),
        digest("attention_mask").alias("attention_mask"),
        digest("labels").alias("labels"),
    )


def q_model_inputs(spark, sf_dir):
    """All three stages to model inputs, with the vocabulary of their own texts."""
    texts = staged_texts(spark, sf_dir)
    keys = ["stage", *KEY]
    inputs = prepare(texts, lambda: F.col("text"), vocab.corpus_vocab(texts), keep=keys)
    return _input_digests(assert_rectangular(inputs), *keys)


def q_model_input_files(spark, sf_dir):
    """Model inputs written as Parquet and read back."""
    inputs = prepare(
        instruction_input_corpus(spark, sf_dir), "instruction_input", COMPAT_VOCAB, keep=KEY
    )
    path = scratch_path(spark, "model-inputs")
    write_model_inputs(inputs, path)
    return _input_digests(spark.read.parquet(path), *KEY)


# Statistics


def q_example_count(spark, sf_dir):
    return stats.count_examples(prompt_response_corpus(spark, sf_dir))


def q_length_stats_padded(spark, sf_dir):
    inputs = pad_and_label(_closed_documents(spark, sf_dir), keep=["lang"])
    return stats.padded_length_stats(inputs, by=["lang"])


def q_length_stats_masked(spark, sf_dir):
    inputs = pad_and_label(_closed_documents(spark, sf_dir), keep=["lang"])
    return stats.masked_length_stats(inputs, by=["lang"])


def q_length_stats_real(spark, sf_dir):
    """Per language and in total (language null)."""
    return stats.real_length_stats(
        _closed_documents(spark, sf_dir), max_length=DEFAULT_MAX_LENGTH, by=["lang"], with_total=True
    )


PER_MILLE = (10, 250, 500, 900, 990, 1000)


def q_length_quantiles(spark, sf_dir):
    """Exact quantiles of text lengths, found by sketches of files that came in two batches."""
    corpus, sketches = scratch_path(spark, "corpus-lengths"), scratch_path(spark, "length-sketches")
    docs = documents(spark, sf_dir).select("lang", "text")
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    for batch in (english, ~english):
        docs.where(batch).select("text").write.mode("append").parquet(corpus)
        update_sketches(spark, lambda files: spark.read.parquet(*(files or [corpus])), F.length("text"), sketches)
    return exact_quantiles(spark, spark.read.parquet(corpus), F.length("text"), sketches, PER_MILLE)


def q_stage_stats(spark, sf_dir):
    texts = staged_texts(spark, sf_dir)
    closed = sequences(texts, lambda: F.col("text"), COMPAT_VOCAB, keep=["stage"])
    return stats.real_length_stats(closed, max_length=DEFAULT_MAX_LENGTH, by=["stage"])


def q_run_summary(spark, sf_dir):
    """One row of corpus statistics written as the run summary and read back."""
    summary = stats.real_length_stats(_closed_documents(spark, sf_dir), max_length=DEFAULT_MAX_LENGTH)
    path = scratch_path(spark, "summary")
    write_summary(spark, summary, path)
    return spark.read.schema(summary.schema).json(path)


# Batch plan


def q_batch_plan(spark, sf_dir):
    return batch_plan(table(spark, sf_dir, "documents"), "doc_id", STEP_SHAPE)


def q_batch_plan_epochs(spark, sf_dir):
    return batch_plan(table(spark, sf_dir, "documents"), "doc_id", EPOCH_SHAPE, seed=7)


def q_batch_plan_summary(spark, sf_dir):
    return plan_summary(batch_plan(table(spark, sf_dir, "documents"), "doc_id", STEP_SHAPE))


def q_batch_plan_permuted(spark, sf_dir):
    """All epochs by a keyed permutation of row numbers: rows get their places without a shuffle."""
    numbers = number_keys(table(spark, sf_dir, "documents"), ["doc_id"], "number", start=0)
    placed = plan_rows(numbers, "number", numbers.count(), EPOCH_SHAPE, seed=7)
    return placed.withColumn("number", F.col("number").cast("bigint"))


def q_batch_plan_resumed(spark, sf_dir):
    """The second half of that plan, computed alone, with the ids of its rows."""
    numbers = number_keys(table(spark, sf_dir, "documents"), ["doc_id"], "number", start=0)
    n = numbers.count()
    rest = resume(spark, n, EPOCH_SHAPE, total_steps(EPOCH_SHAPE, n) // 2, seed=7)
    return rest.join(numbers, "number").select("doc_id", "epoch", "step", "accum", "rank", "slot")


def q_shard_export(spark, sf_dir):
    """Closed sequences exported per rank and read back."""
    pairs = prompt_response_corpus(spark, sf_dir).withColumn("example", F.concat_ws("-", *KEY))
    closed = sequences(pairs, "prompt_response", COMPAT_VOCAB, keep=["example"])
    path = scratch_path(spark, "shards")
    export_shards(closed, path, "example", EPOCH_SHAPE)
    back = read_shard(spark, path)
    return _input_digests(back, "example", "epoch", "step", "accum", "rank", "slot")


# Test cases and responses


def q_test_case_inputs(spark, sf_dir):
    return case_inputs(conversation_cases(spark, sf_dir))


def q_case_count(spark, sf_dir):
    return count_cases(conversation_cases(spark, sf_dir))


def _size_of_talk(messages: list[dict[str, str]]) -> str:
    """Stands for a model: answers with sizes and fails on some inputs."""
    n_chars = len(messages[-1]["content"])
    if n_chars % 5 == 0:
        raise ValueError(f"{n_chars} characters")
    return f"{len(messages)} messages, {n_chars} characters"


def q_batch_responses(spark, sf_dir):
    return batch_responses(conversation_cases(spark, sf_dir), _size_of_talk)


def q_batch_responses_resumed(spark, sf_dir):
    """The same as a stream over case files with a journal; a second job finds every case answered."""
    cases = write_cases(conversation_cases(spark, sf_dir).repartition("test_case"), scratch_path(spark, "cases"))
    journal = scratch_path(spark, "journal")
    for _ in range(2):
        start_responses(spark, cases, journal, scratch_path(spark, "responses"), _size_of_talk, files_per_batch=4).awaitTermination()
    return read_journal(spark, journal)


def q_result_json_roundtrip(spark, sf_dir):
    responses = batch_responses(conversation_cases(spark, sf_dir), _size_of_talk)
    path = scratch_path(spark, "results")
    write_results(responses, path)
    return as_results(spark.read.schema(RESULT).json(path))


def q_case_json_roundtrip(spark, sf_dir):
    path = write_cases(conversation_cases(spark, sf_dir), scratch_path(spark, "cases"))
    return message_rows(read_cases(spark, path), "test_case")


CASES_PER_FILE = 1000


def q_case_array_files(spark, sf_dir):
    """Benchmark items as files with a JSON array of about 1,000 conversations each, numbered over all."""
    path = scratch_path(spark, "case-arrays")
    items = table(spark, sf_dir, "benchmark")
    talk = F.array(
        F.struct(F.lit("system").alias("role"), F.concat(F.lit("item "), F.col("item_id")).alias("content")),
        F.struct(F.lit("user").alias("role"), F.col("text").alias("content")),
    )
    # Files are ranges in the order of the cases; they are written once, so that every later read sees the same ones.
    half = (F.col("item_id") % 2).alias("half")
    keyed = items.select(half, "item_id", talk.alias("talk"))
    ranged = keyed.repartitionByRange(max(1, math.ceil(items.count() / CASES_PER_FILE)), "half", "item_id")
    ranged = ranged.withColumn("file", F.lpad(F.spark_partition_id().cast("string"), 10, "0"))
    parts = scratch_path(spark, "case-ranges")
    ranged.write.parquet(parts)
    suites = spark.read.schema(ranged.schema).parquet(parts).groupBy("file").agg(
        F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("half", "item_id", "talk"))), lambda r: r["talk"])).alias("value")
    )
    suites.write.partitionBy("file").text(path)
    cases = read_cases(spark, path, "array")
    return cases.select(
        "test_case", F.size("messages").alias("turns"), last_content().alias("input"), F.get("messages", 0)["content"].alias("first")
    )


def _sizes_of_talks(talks: list[list[dict[str, str]]]) -> list[str | Exception]:
    """A model that takes several conversations at a time; failures stand in the list."""
    out = []
    for messages in talks:
        try:
            out.append(_size_of_talk(messages))
        except ValueError as e:
            out.append(e)
    return out


def q_batch_responses_batched(spark, sf_dir):
    return batch_responses(conversation_cases(spark, sf_dir), _sizes_of_talks, batch_size=16)


def _load_word_tokenizer():
    return _word_lengths


def q_model_inputs_tokenizer(spark, sf_dir):
    """A tokenizer that is loaded in the task, through the whole way to model inputs."""
    inputs = prepare(
        prompt_response_corpus(spark, sf_dir), "prompt_response", setup=_load_word_tokenizer, max_length=128, keep=KEY
    )
    return _input_digests(assert_rectangular(inputs, 128), *KEY)


def _frame_batch(batch: dict[str, list]) -> dict[str, list]:
    pairs = zip(batch["prompt"], batch["response"], strict=True)
    return {"text": ["".join((FRAME_HEAD, p, FRAME_MIDDLE, r, FRAME_TAIL)) for p, r in pairs]}


def q_map_batches(spark, sf_dir):
    return map_batches(
        prompt_response_corpus(spark, sf_dir),
        _frame_batch,
        "text string",
        keep=KEY,
        columns=["prompt", "response"],
    )


def q_map_batches_spread(spark, sf_dir):
    """The same over 12 tasks, however few the source has, and the number of tasks it ran in."""
    pairs = spread(prompt_response_corpus(spark, sf_dir), 3)
    made = map_batches(pairs, _frame_batch, "text string", keep=KEY, columns=["prompt", "response"], partitions=12)
    tasks = F.lit(made.rdd.getNumPartitions()).cast("bigint").alias("tasks")
    return made.select(*KEY, F.md5("text").alias("text"), tasks)


# Corpora on disk


def _document_corpus(spark: SparkSession, sf_dir: str, format: str) -> str:
    """Documents as a prompt and response corpus, one split per language."""
    path = scratch_path(spark, f"corpus-{format}")
    corpus = table(spark, sf_dir, "documents").select(
        F.col("source").alias("prompt"), F.col("text").alias("response"), F.col("lang").alias("split")
    )
    write_corpus(corpus, path, format)
    return path


def _split_digest(corpus: DataFrame) -> DataFrame:
    return corpus.select("split", "prompt", F.md5("response").alias("response"))


def q_corpus_parquet(spark, sf_dir):
    path = _document_corpus(spark, sf_dir, "parquet")
    return _split_digest(read_corpus(spark, path, "prompt_response"))


def q_corpus_json(spark, sf_dir):
    path = _document_corpus(spark, sf_dir, "json")
    return _split_digest(read_corpus(spark, path, "prompt_response", "json"))


def q_corpus_csv(spark, sf_dir):
    path = _document_corpus(spark, sf_dir, "csv")
    return _split_digest(read_corpus(spark, path, "prompt_response", "csv"))


def _padded_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instruction rows whose inputs are empty, blank, padded or null, with a key in the output."""
    made = instruction_input_corpus(spark, sf_dir)
    form = F.col("turn") % 6
    padded = F.when(form == 1, F.lit(None).cast("string")).when(form == 3, F.concat(F.lit("  "), "input", F.lit(" \n\"q\", ")))
    return made.select(
        "instruction",
        F.when(form.isin(1, 3), padded).otherwise(F.col("input")).alias("input"),
        F.concat_ws("-", *KEY).alias("output"),
        F.when(F.col("conv_id") % 2 == 0, F.lit("train")).otherwise(F.lit("test")).alias("split"),
    )


def _instruction_digest(corpus: DataFrame) -> DataFrame:
    rendered = render_instruction_input()
    return corpus.select("split", "output", F.md5("instruction").alias("instruction"), "input", F.md5(rendered).alias("text"))


def q_corpus_csv_instruction(spark, sf_dir):
    """Three columns through CSV: empty, blank, padded and null inputs come back as they were."""
    path = scratch_path(spark, "corpus-csv")
    write_corpus(_padded_texts(spark, sf_dir), path, "csv")
    return _instruction_digest(read_corpus(spark, path, "instruction_input", "csv"))


def q_corpus_json_instruction(spark, sf_dir):
    path = scratch_path(spark, "corpus-json")
    write_corpus(_padded_texts(spark, sf_dir), path, "json")
    return _instruction_digest(read_corpus(spark, path, "instruction_input", "json"))


def q_corpus_system_user(spark, sf_dir):
    """System, user and answer from Parquet files, a directory for each split."""
    path = scratch_path(spark, "corpus-system-user")
    split = F.when(F.col("conv_id") % 2 == 0, F.lit("train")).otherwise(F.lit("validation"))
    corpus = system_user_corpus(spark, sf_dir).select("system_prompt", "user_prompt", "answer", split.alias("split"))
    write_corpus(corpus, path)
    back = read_corpus(spark, path, "system_user")
    return back.select("split", render_system_user().alias("text"))


def _named_files(corpus: DataFrame, name: Column, path: str) -> None:
    """One flat folder of Parquet files whose names start with ``name``, as hub corpora have them."""
    apart = f"{path}-apart"
    corpus.withColumn("name", name).write.partitionBy("name").parquet(apart)
    spark = corpus.sparkSession
    paths = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = paths(apart).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(paths(path))
    for folder in files.listStatus(paths(apart)):  # one for each name
        of = folder.getPath()
        if folder.isDirectory():
            for k, file in enumerate(f for f in files.listStatus(of) if f.getPath().getName().startswith("part-")):
                files.rename(file.getPath(), paths(f"{path}/{of.getName().split('=')[1]}-{k:05d}.parquet"))


def q_split_by_file_name(spark, sf_dir):
    """Splits named by files: `test-*` and `validation-*` are theirs, every other name is the training split's."""
    path = scratch_path(spark, "corpus-files")
    docs = table(spark, sf_dir, "documents")
    names = F.when(F.col("lang") == "en", "train").when(F.col("lang") == "de", "test").when(F.col("lang") == "fr", "validation").otherwise("other")
    _named_files(docs.select("lang", F.col("source").alias("prompt"), F.md5("text").alias("response")), names, path)
    return read_corpus(spark, path, "prompt_response", splits="file").select("split", "prompt", "response")


def q_corpus_columns(spark, sf_dir):
    """The source columns of a corpus on disk, with the rows and the characters that each holds."""
    corpus = read_corpus(spark, _document_corpus(spark, sf_dir, "parquet"), "prompt_response")
    held = [
        F.struct(F.lit(c).alias("column"), F.count(c).alias("rows"), F.sum(F.length(c)).cast("bigint").alias("chars")) for c in corpus_columns(corpus)
    ]
    return corpus.agg(F.array(*held).alias("held")).select(F.inline("held"))


def q_split_selection(spark, sf_dir):
    path = _document_corpus(spark, sf_dir, "parquet")
    chosen = read_corpus(spark, path, "prompt_response", split="en")
    return chosen.select("prompt", F.md5("response").alias("response"))


# Logs, URIs, time stamps


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as log lines in six forms, all the metric patterns have to tell apart."""
    cents = F.round(F.col("value") * 100).cast("long")
    number = F.concat(
        F.floor(cents / 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0")
    )
    form = F.col("event_id") % 6
    head = F.concat(F.lit("step "), F.col("event_id").cast("string"), F.lit(" "))
    line = (
        F.when(form == 0, F.concat(head, F.lit("train_loss: "), number))
        .when(form == 1, F.concat(head, F.lit("train_loss: "), number, F.lit("e-05")))
        .when(form == 2, F.concat(head, F.lit("{'train_loss': "), number, F.lit("}")))
        .when(form == 3, F.concat(head, F.lit("train_loss: "), number, F.lit(".1")))
        .when(form == 4, F.concat(head, F.lit("eval_loss: "), number))
        .otherwise(F.concat(head, F.lit("train_loss: "), number, F.lit(" eval_loss: "), number))
    )
    return table(spark, sf_dir, "events").select(line.alias("value"))


def q_loss_metrics(spark, sf_dir):
    return extract_metrics(log_lines(spark, sf_dir), keep=["value"]).toDF("line", "metric", "value")


def q_loss_metrics_float(spark, sf_dir):
    return extract_metrics(log_lines(spark, sf_dir), FLOAT_METRICS, keep=["value"]).toDF(
        "line", "metric", "value"
    )


def q_loss_metrics_files(spark, sf_dir):
    path = scratch_path(spark, "logs")
    log_lines(spark, sf_dir).write.text(path)
    return extract_metrics(read_logs(spark, path), keep=["value"]).toDF("line", "metric", "value")


def q_loss_metrics_stream(spark, sf_dir):
    path = scratch_path(spark, "log-stream")
    log_lines(spark, sf_dir).write.text(f"{path}/in")
    start_metric_stream(spark, f"{path}/in", f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return spark.read.schema("line string, metric string, value double").parquet(f"{path}/out")


def q_uri_parts(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", uri_bucket("url").alias("bucket"), uri_key("url").alias("key")
    )


def q_timestamp_keys(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        timestamp_key("ts").alias("path_key"),
        timestamp_key("ts", "yyyyMMdd_HHmmss").alias("file_key"),
    )


def q_sequence_stats(spark, sf_dir):
    """The whole way: pairs, rendering, ids, model inputs, statistics."""
    inputs = prepare(
        prompt_response_corpus(spark, sf_dir),
        "prompt_response",
        vocab.corpus_vocab(table(spark, sf_dir, "conversations")),
    )
    return stats.masked_length_stats(assert_rectangular(inputs))


QUERIES = {name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_")}
