"""A corpus from raw documents to packed sequences: each stage works on all rows that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import language, line_dedup, near_dedup, packing, toxicity
from corpusloom.llm.bpe import tokenizer_path
from corpusloom.llm.common import staged, table

#: The least score of a language; a text in which no language stands out has less.
MIN_LANGUAGE_SCORE = 0.3
SIMILARITY = 80
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression distance calls toxic go."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where("predicted = 0").select(*COLUMNS)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or without a clear language go."""
    filters = language.fit_documents(docs)
    if not filters.languages:  # nothing to learn from, nothing to reject by
        return docs.select(*COLUMNS)
    found = language.identify(docs, filters)
    return found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)).select(*COLUMNS)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many sites share go; all documents stay."""
    out = line_dedup.line_dedup(docs.select(*COLUMNS))
    length = F.when(F.col("n_lines_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", length).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row with the smallest id stays; rows without an id stay."""
    return near_dedup.drop_near_duplicates(docs.select(*COLUMNS), SIMILARITY)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All pieces of all documents with their place in a sequence."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", drop_unknown_language),
    ("line_dedup", drop_common_lines),
    ("near_dedup", drop_near_copies),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Trained stages and packing have no SQL form; tests/llm holds them against brute force.
ORACLE_SQL = None
