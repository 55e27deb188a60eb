"""Language identification with bitmask n-gram filters.

Training: character trigrams are counted by language over a bounded sample of labelled texts. A trigram
belongs to a language if its rate there is at least ``SHARE`` of its highest rate in any language; each
language takes at most ``MAX_GRAMS`` of them, the most frequent first. All go into one bit-sliced
Bloom filter: a slot holds one bit for each language, so the AND over the slots of a trigram is the set
of all languages that contain it.

Prediction: the popcounts of these sets over the trigrams of the whole text, one for each language,
are corrected for the filter's false positives, which its fill gives; the largest decides, ties go to
the more frequent language. The score is its part of the sum of all corrected popcounts.

A null text, or one without a letter, is ``und`` with score 0, as is every text if nothing was learned;
texts of any length are read whole, in pieces; equal texts get equal results; an empty table gives an
empty table. Rows without a language are not learned from.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.bpe import worker_cache
from corpusloom.llm.common import in_pieces, staged, table
from corpusloom.llm.words import mix

#: Bounds of the training sample: texts for each language, and characters of a text to be in it.
TRAIN_TEXTS = 1500
TRAIN_CHARS = 20_000
MAX_GRAMS = 60_000
MIN_COUNT = 3
SHARE = 0.5
HASHES = 3
SLOTS_PER_GRAM = 16
PIECE = 1 << 18
UNKNOWN = "und"
PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def _letter_table() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x30000)), dtype=bool, count=0x30000)


def grams(text: str, letters: np.ndarray) -> Iterator[np.ndarray]:
    """Trigrams of lower-cased letters with one blank between words, 21 bits for a character, piece by piece."""
    tail = ""
    for at in range(0, len(text), PIECE):
        codes = np.frombuffer((tail + text[at : at + PIECE].lower()).encode("utf-32-le", "replace"), dtype=np.uint32)
        tail = text[max(0, at + PIECE - 2) : at + PIECE].lower()
        known = letters[np.minimum(codes, len(letters) - 1)]
        codes = np.where(known, codes, np.uint32(32))
        blank = ~known
        codes = codes[~(blank & np.r_[False, blank[:-1]])].astype(np.uint64)
        if len(codes) >= 3:
            yield (codes[:-2] << np.uint64(42)) | (codes[1:-1] << np.uint64(21)) | codes[2:]


@dataclass(frozen=True)
class Filters:
    """``slots`` has one row for each slot, with the languages' bits in words of 64."""

    languages: tuple[str, ...]
    slots: np.ndarray
    false_positive: np.ndarray

    def masks(self, keys: np.ndarray) -> np.ndarray:
        """The language sets of trigrams, as rows of words."""
        bits = np.uint64(64 - int(len(self.slots)).bit_length() + 1)
        found = None
        for k in range(HASHES):
            got = self.slots[(mix(keys * PLACES[k]) >> bits).astype(np.int64)]
            found = got if found is None else found & got
        return found

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """For each language, how many of the trigrams are in its set."""
        masks = self.masks(keys)
        if masks.shape[1] == 1 and len(self.languages) <= 8:
            sets = np.bincount(masks[:, 0].astype(np.int64), minlength=256)
            return np.array([sets[(np.arange(256) >> i) & 1 == 1].sum() for i in range(len(self.languages))], dtype=np.int64)
        return np.array(
            [int(((masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).sum()) for i in range(len(self.languages))], dtype=np.int64
        )

    def predict(self, text: str | None, letters: np.ndarray) -> tuple[str, float]:
        if text is None or not self.languages or not any(c.isalpha() for c in text):
            return UNKNOWN, 0.0
        n, hits = 0, np.zeros(len(self.languages), dtype=np.int64)
        for keys in grams(text, letters):
            n += len(keys)
            hits += self.counts(keys)
        true = np.maximum(0.0, (hits - n * self.false_positive) / (1 - self.false_positive))
        best = int(true.argmax())
        total = float(true.sum())
        return self.languages[best], float(true[best] / total) if total > 0 else 0.0


def build(languages: list[str], keys: list[np.ndarray]) -> Filters:
    """The filter over the trigrams of each language."""
    most = max([1, *map(len, keys)])
    bits = max(10, int(SLOTS_PER_GRAM * most - 1).bit_length())
    slots = np.zeros((1 << bits, max(1, -(-len(languages) // 64))), dtype=np.uint64)
    for i, own in enumerate(keys):
        for k in range(HASHES):
            at = (mix(own * PLACES[k]) >> np.uint64(64 - bits)).astype(np.int64)
            slots[at, i // 64] |= np.uint64(1 << (i % 64))
    fill = [float(((slots[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean()) for i in range(len(languages))]
    return Filters(tuple(languages), slots, np.minimum(np.array(fill) ** HASHES, 0.99))


def _gram_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    letters = _letter_table()
    for batch in in_pieces(batches):
        by_language: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            by_language.setdefault(lang, []).extend(grams(text, letters))
        for lang, parts in by_language.items():
            if parts:
                keys, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_pydict(
                    {"lang": pa.array([lang] * len(keys)), "gram": pa.array(keys.astype(np.int64)), "n": pa.array(n.astype(np.int64))}
                )


def fit(df: DataFrame, texts: int = TRAIN_TEXTS, chars: int = TRAIN_CHARS) -> Filters:
    """Filters from (id, text, lang): about ``texts`` texts of at most ``chars`` characters for each language.

    The sample is taken by a hash of the id, with one threshold for each language that follows from
    the number of its texts. What comes to the driver is bounded by the number of languages.
    """
    usable = df.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return build([], [])
    languages = sorted(sizes, key=lambda x: (-sizes[x], x))
    scale = 1 << 30
    rates = df.sparkSession.createDataFrame([(x, min(scale, texts * scale // sizes[x])) for x in languages], "lang string, most bigint")
    drawn = usable.where(F.length("text") <= chars).join(F.broadcast(rates), "lang")
    drawn = drawn.where(F.pmod(F.xxhash64(F.lit("language"), "id"), F.lit(scale)) < F.col("most")).select("lang", "text")
    counts = drawn.mapInArrow(_gram_counts, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = staged(counts, "gram_counts")
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    weights = df.sparkSession.createDataFrame([(x, float(n)) for x, n in totals.items()], "lang string, total double")
    rated = counts.where(F.col("n") >= MIN_COUNT).join(F.broadcast(weights), "lang").withColumn("rate", F.col("n") / F.col("total"))
    tops = rated.groupBy("gram").agg(F.max("rate").alias("top"))
    own = rated.join(tops, "gram").where(F.col("rate") >= SHARE * F.col("top"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    kept = own.withColumn("rank", rank).where(F.col("rank") <= MAX_GRAMS).select("lang", "gram").toPandas()
    return build(languages, [kept.loc[kept["lang"] == x, "gram"].to_numpy().astype(np.uint64) for x in languages])


def identify(df: DataFrame, filters: Filters, text: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score``; input columns of these names are replaced."""
    spark = df.sparkSession
    sent = spark.sparkContext.broadcast((filters.languages, filters.slots, filters.false_positive))  # bounded by MAX_GRAMS
    fields = [f for f in df.schema if f.name not in ("lang_pred", "score")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("language")  # lets those of earlier steps go
        letters, own = _letter_table(), Filters(*sent.value)
        for batch in in_pieces(batches):
            found = [own.predict(x.as_py(), letters) for x in batch.column(text)]
            columns = {f.name: batch.column(f.name) for f in fields}
            columns["lang_pred"] = pa.array([x for x, _ in found], pa.string())
            columns["score"] = pa.array([x for _, x in found], pa.float64())
            yield pa.RecordBatch.from_pydict(columns)

    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return df.select(*(F.col(f"`{f.name}`") for f in fields)).mapInArrow(run, schema)


def remainder(column: str, parts: int) -> Column:
    """crc32 of an id as text, modulo ``parts``; 0 for null."""
    return F.coalesce(F.pmod(F.crc32(F.encode(F.col(column).cast("string"), "UTF-8")), F.lit(parts)), F.lit(0)).cast("int")


HELD_OUT = (4, 2)


def fit_documents(docs: DataFrame) -> Filters:
    """Filters from the documents whose remainder isn't the held-out one."""
    parts, held = HELD_OUT
    learn = docs.select(F.col("doc_id").alias("id"), "text", "lang").where(F.col("id").isNotNull() & (remainder("id", parts) != held))
    return fit(learn)


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    """The language of every document, from filters of the three other quarters of the ids."""
    docs = table(spark, sf_dir, "documents")
    parts, held = HELD_OUT
    rows = docs.select("doc_id", "text", (remainder("doc_id", parts) == held).alias("held_out"))
    return identify(rows, fit_documents(docs)).select("doc_id", "held_out", "lang_pred", "score")
