"""Toxicity by compression distance with two zstandard dictionaries.

Training, on bounded samples of labelled texts:

1. Character n-grams that far more toxic than ordinary texts contain mark the toxic passages.
2. One dictionary is trained on ordinary texts, a second one on the toxic passages. The toxic side
   compresses with both, the ordinary side with the ordinary one and filler in place of the other, so
   a difference in length comes from toxic passages alone.
3. On labelled texts that the dictionaries have not seen, a logistic rule over the largest difference
   of a window and the sum of the clear ones gives calibrated scores.

Prediction: both sides compress every window, which is a word between marks for its limits, and the differences
give the score. Differences of recent windows are kept in a dictionary of bounded size.

An empty or null text has no window and gets the score of no difference; texts of any length are read
whole; equal texts get equal scores; an empty table gives an empty table. Without labels of
both kinds all texts get score 0.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.bpe import Recent, worker_cache
from corpusloom.llm.common import in_pieces, table, texts
from corpusloom.llm.language import remainder
from corpusloom.llm.words import mix, shingle_set, word_hashes

#: Bounds of the sample: labelled texts of each kind, and characters of a text to be in it.
TRAIN_TOXIC = 2000
TRAIN_ORDINARY = 4000
TRAIN_CHARS = 10_000
#: A window is a word with the blanks around it; of a longer word, each run of this many bytes.
WINDOW = 64
CLEAR = 3  # bytes; a smaller difference of a window is not counted in the sum
DICT_BYTES = 112_640
TOXIC_BYTES = 8192
LEVEL = 19
CACHE_ENTRIES = 150_000
#: Stands before each window, so that a block is always worth compressing.
LEAD = b" " * 24
#: Stands for the blanks between words on both sides: bytes that no window has, and enough of them to tell where words begin.
MARK = b"\x01\x02\x03"
#: Lengths of the character n-grams that mark toxic passages, blanks at word limits included, and the evidence that
#: one needs: the negative logarithm of the chance that all its texts are toxic ones if labels don't matter.
GRAMS = (4, 5, 6, 7, 8)
EVIDENCE = 12.0


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]  # of 1, the largest difference, the logarithm of the clear sum


def _content(samples: list[bytes], size: int) -> bytes:
    """The content of a trained dictionary; the samples themselves where they are too few to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]


#: A-Z as a-z; all other ASCII characters that are no letters as blanks.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def windows(data: bytes) -> list[bytes]:
    """Words of a text; words longer than a window in runs that overlap by half."""
    words = data.translate(WORD_BYTES).split()
    if any(len(w) > WINDOW for w in words):
        words = [w[at : at + WINDOW] for w in words for at in (range(0, max(1, len(w) - WINDOW // 2), WINDOW // 2) if len(w) > WINDOW else (0,))]
    return words


class Scorer:
    """Compressors for both sides. The dictionaries have one length, so that equal matches cost the same."""

    def __init__(self, model: Model):
        import zstandard

        def side(content: bytes):
            kind = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            kind.precompute_compress(LEVEL)
            return zstandard.ZstdCompressor(level=LEVEL, dict_data=kind, write_content_size=False, write_dict_id=False)

        # Bytes that no UTF-8 text has.
        filler = np.random.Generator(np.random.PCG64(3)).integers(0xF8, 0x100, len(model.toxic), dtype=np.uint8).tobytes()
        self.zstandard, self.model = zstandard, model
        self.sides = [side(model.ordinary + filler), side(model.ordinary + model.toxic)]
        self.shorter = Recent(CACHE_ENTRIES)

    def _differences(self, words: list[bytes]) -> list[int]:
        """By how many bytes the toxic side is shorter, window by window."""
        sizes = []
        for at in range(0, len(words), 8192):
            own = [LEAD + MARK + w + MARK for w in words[at : at + 8192]]
            ends = np.cumsum([len(w) for w in own])
            spans = np.stack([np.r_[0, ends[:-1]], np.diff(ends, prepend=0)], axis=1).astype(np.uint64)
            joined = self.zstandard.BufferWithSegments(b"".join(own), spans.tobytes())
            made = [[len(x) for x in side.multi_compress_to_buffer(joined)] for side in self.sides]
            sizes += [a - b for a, b in zip(*made)]
        return sizes

    def features(self, texts: list[bytes | None]) -> list[tuple[float, float]]:
        """For each text, the largest difference of a window, and the logarithm of the sum of the clear ones."""
        self.shorter.turn()
        rows = [windows(t or b"") for t in texts]
        distinct = set().union(*rows)
        new = self.shorter.missing(distinct)
        known = self.shorter.now
        known.update(zip(new, self._differences(new)))
        clear = {w: known[w] for w in distinct if known[w] > 0}
        out = []
        for row in rows:
            found = [clear[w] for w in row if w in clear]
            out.append((float(max(found, default=0)), math.log1p(sum(d for d in found if d >= CLEAR))))
        return out

    def score(self, texts: list[bytes | None]) -> list[float]:
        w = self.model.weights
        if not w:
            return [0.0] * len(texts)
        raw = [w[0] + w[1] * top + w[2] * total for top, total in self.features(texts)]
        return [1.0 / (1.0 + math.exp(-min(40.0, max(-40.0, x)))) for x in raw]


def toxic_passages(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """The parts of words of toxic texts, with the marks around them, that n-grams typical of toxic texts cover."""

    def grams(word: str) -> list[tuple[int, str]]:
        padded = f" {word} "
        return [(i, padded[i : i + n]) for n in GRAMS for i in range(len(padded) - n + 1)]

    def words(text: bytes) -> list[str]:
        return [w.decode("utf-8", "ignore") for w in windows(text)]

    def counted(rows: list[bytes]) -> Counter:
        out: Counter = Counter()
        for row in rows:
            out.update({g for w in set(words(row)) for _, g in grams(w)})
        return out

    in_toxic, in_ordinary = counted(toxic), counted(ordinary)
    surprise = math.log((len(toxic) + len(ordinary)) / len(toxic))
    typical = {g for g, n in in_toxic.items() if n * surprise >= EVIDENCE and in_ordinary[g] * 50 <= n}
    out = []
    for row in toxic:
        for w in words(row):
            spans = [(i, i + len(g)) for i, g in grams(w) if g in typical]
            if spans:
                out.append(f" {w} "[min(i for i, _ in spans) : max(end for _, end in spans)])
    return [x.encode().replace(b" ", MARK) for x in out]


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 0.01) -> np.ndarray:
    """Weights by Newton's method."""
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(x.shape[1])
    keep = ridge * np.r_[0.0, np.ones(x.shape[1] - 1)] + 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + keep * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(keep)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def without_copies(rows: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The rows without those that share an extreme shingle with an earlier one: near copies would count as many witnesses."""
    seen: set[int] = set()
    out = []
    for row in rows:
        shingles = shingle_set(word_hashes(row[0].encode()))
        if len(shingles):
            other = mix(shingles)
            keys = {int(shingles[0]), int(shingles[-1]), int(other.min()), int(other.max())}
            if not keys & seen:
                out.append(row)
            seen |= keys
    return out


def train(rows: list[tuple[str, int, int]]) -> Model:
    """From (text, toxic, fold): dictionaries from fold 0, weights from fold 1."""
    rows = without_copies(rows)
    toxic = [t.encode() for t, y, k in rows if y == 1 and k == 0]
    ordinary = [t.encode() for t, y, k in rows if y == 0 and k == 0]
    check = [(t, y) for t, y, k in rows if k == 1]
    if not toxic or not ordinary or len({y for _, y in check}) < 2:
        return Model(b"", b"", ())
    marked = [MARK + MARK.join(windows(t)) + MARK for t in ordinary]
    samples = [t[at : at + 512] for t in marked for at in range(0, len(t), 512)]
    common = _content(samples, DICT_BYTES)
    counted = Counter(toxic_passages(toxic, ordinary))
    often = [w for w, n in sorted(counted.items(), key=lambda e: (e[1], e[0]))]
    # The trainer needs far more text than a dictionary holds; few passages are the dictionary themselves.
    joined = b"".join(often)
    special = joined if len(joined) <= TOXIC_BYTES else _content([w for w in often for _ in range(min(counted[w], 50))], TOXIC_BYTES)
    model = Model(common, special, (0.0, 0.0, 0.0))
    scorer = Scorer(model)
    x = np.array(scorer.features([t.encode() for t, _ in check]))
    w = _logistic(x, np.array([y for _, y in check], dtype=float))
    return Model(common, special, tuple(float(v) for v in w))


def fit(docs: DataFrame, labels: DataFrame, toxic: int = TRAIN_TOXIC, ordinary: int = TRAIN_ORDINARY, chars: int = TRAIN_CHARS) -> Model:
    """A model from the labelled documents whose remainder by 5 isn't 0.

    Samples are drawn by a hash of the id: about ``toxic`` and ``ordinary`` texts, of at most ``chars``
    characters; both come to the driver, which these bounds allow.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (remainder("doc_id", 5) != 0))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if set(sizes) != {0, 1}:
        return Model(b"", b"", ())
    scale = 1 << 30
    most = F.when(F.col("toxic") == 1, min(scale, toxic * scale // sizes[1])).otherwise(min(scale, ordinary * scale // sizes[0]))
    key = F.xxhash64(F.lit("toxicity"), "doc_id")
    drawn = known.where(F.pmod(key, F.lit(scale)) < most).withColumn("fold", (F.pmod(F.shiftright(key, 40), F.lit(3)) == 0).cast("int"))
    rows = docs.select("doc_id", "text").where(F.col("text").isNotNull() & (F.length("text") <= chars)).join(F.broadcast(drawn), "doc_id")
    got = rows.select("text", "toxic", "fold").collect()
    return train(sorted((r["text"], r["toxic"], r["fold"]) for r in got))


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds ``score`` and ``predicted``; input columns of these names are replaced."""
    sent = df.sparkSession.sparkContext.broadcast((model.ordinary, model.toxic, model.weights))  # bounded by the dictionaries' size
    fields = [f for f in df.schema if f.name not in ("score", "predicted")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*sent.value)
        kept = worker_cache("toxicity")  # of one model: the windows' differences are good for all tasks of a worker
        if kept.get("model") != sent.value:
            kept.update(model=sent.value, scorer=Scorer(model) if model.weights else None)
        for batch in in_pieces(batches):
            found = kept["scorer"].score(list(texts(batch.column(text)))) if kept["scorer"] else [0.0] * batch.num_rows
            columns = {f.name: batch.column(f.name) for f in fields}
            columns["score"] = pa.array(found, pa.float64())
            columns["predicted"] = pa.array([int(x >= 0.5) for x in found], pa.int32())
            yield pa.RecordBatch.from_pydict(columns)

    schema = T.StructType([*fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return df.select(*(F.col(f"`{f.name}`") for f in fields)).mapInArrow(run, schema)


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    """The score of every document, from labels of the four other fifths of the ids."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", "text", (remainder("doc_id", 5) == 0).alias("held_out"))
    return score(rows, model).select("doc_id", "held_out", "score", "predicted")
