"""A language model by logistic context mixing, trained on a corpus, that scores whole texts.

A text is taken as its words ``[^\\x20\\x09-\\x0D]+`` with A-Z as a-z, each followed by a space, and one end. The
bytes of that are predicted bit by bit along a Huffman code of the training bytes:

1. **Predictors.** For the last 1 to 5 bytes and the node of the code, hashed into a table for each order, how often
   the next bit was 0 and 1 in all training texts. Tasks count their texts, and the counts are added up slot by slot.
2. **Mixing.** The predictions, stretched to log odds, are added with weights. Two gates choose them: how often the longer
   contexts were seen, and the node of the code. Weights are learned online, bit after bit: each task goes through its texts of a
   fold (those of ``TUNING_FOLD``) that the tables used then have not counted, and the weights of all tasks are averaged.
3. **Refinement.** The mixed probability is averaged with what that probability, in that gate, was worth in the fold.
   For the texts themselves the tables hold all training texts.
4. **Words.** At the start of each token the byte model is mixed with the counts of whole tokens in all training
   texts, a table that grows with the corpus. The share of either is refined as the text goes on: the score is that of a
   Bayesian mixture of several shares. A token that was never seen is spelled by the byte model.

A text's score depends on the model and the text alone. The predictor tables are of a fixed size by parameter
(``BITS``), and the token counts stay distributed: each block of texts sends its distinct tokens once to the
counts and gets them back, so no vocabulary is ever sent whole.

A null or empty text is its end alone. A null id is not held out. Repeated rows get equal results. An empty
table gives an empty one; without a training text all counts are 0. Very long texts are read in pieces.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from corpusloom.llm.common import in_pieces, staged, table, texts
from corpusloom.llm.words import mix

ORDERS = (1, 2, 3, 4, 5)
#: Binary logarithm of the slots of the table of each order.
BITS = (16, 18, 20, 21, 22)
CONTEXT = 5
PIECE = 1 << 20
GROUP = 2 << 20
BLOCK = 32 << 20
#: Binary logarithm of the keys that a task remembers.
REMEMBERED = 21
LONG_TOKEN = 256
CHUNK = 1 << 13
END = np.uint64(0x9D39247E33776D41)
SPACE_BYTE, END_BYTE = 32, 10
NORMAL = bytes.maketrans(bytes(range(65, 91)) + bytes(range(9, 14)), bytes(range(97, 123)) + b" " * 5)
FOLDS, HELD_OUT, TUNING_FOLD = 5, 1, 0
LIMIT = 8.0
STEP = 1 << 15
LEARN_STEP = 1 << 12
RATE = 0.02
SHARES = (0.02, 0.2, 0.5, 0.8)
BUCKETS = 33


def normalized(text: bytes | None) -> bytes:
    """The words of a text, each with a space behind it, and the end."""
    words = (text or b"").translate(NORMAL).split()
    return b" ".join([*words, b"\n"])


def token_hashes(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the tokens of normalized texts, one text after the other, and how many each text has."""
    joined = b"".join(docs)
    codes = np.frombuffer(joined, dtype=np.uint8)
    ends = np.flatnonzero((codes == SPACE_BYTE) | (codes == END_BYTE))
    starts = np.r_[0, ends[:-1] + 1] if len(ends) else ends
    lengths = ends - starts
    # Eight bytes of all tokens at a time.
    words = np.ndarray((len(joined) + 1,), "<u8", joined + b"\0" * 8, 0, (1,))
    out = mix(lengths.astype(np.uint64) + ODD[13])
    open_ = np.flatnonzero((lengths > 0) & (lengths <= LONG_TOKEN))
    at = 0
    while len(open_):
        left = np.minimum(lengths[open_] - at, 8).astype(np.uint64)
        out[open_] = mix(out[open_] ^ (words[starts[open_] + at] & (~np.uint64(0) >> (np.uint64(64) - left * np.uint64(8)))))
        at += 8
        open_ = open_[lengths[open_] > at]
    for i in np.flatnonzero(lengths > LONG_TOKEN):
        out[i] = xxhash.xxh64_intdigest(joined[starts[i] : ends[i]])
    closed = codes[ends] == END_BYTE
    out[closed] = END
    return out, np.diff(np.flatnonzero(closed), prepend=-1)


@dataclass
class ByteCode:
    """A Huffman code of bytes: for each byte the nodes and bits on its way."""

    nodes: np.ndarray
    bits: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray) -> ByteCode:
        heap = [(int(n) + 1, b, b) for b, n in enumerate(counts)]
        heapq.heapify(heap)
        parent, inner = {}, 256
        while len(heap) > 1:
            (n, _, x), (m, _, y) = heapq.heappop(heap), heapq.heappop(heap)
            parent[x], parent[y] = (inner, 0), (inner, 1)
            heapq.heappush(heap, (n + m, inner, inner))
            inner += 1
        ways = []
        for b in range(256):
            way, at = [], b
            while at in parent:
                at, bit = parent[at]
                way.append((at - 256, bit))
            ways.append(way[::-1])
        longest = max(map(len, ways))
        nodes, bits = np.zeros((longest, 256), dtype=np.uint8), np.zeros((longest, 256), dtype=np.uint8)
        for b, way in enumerate(ways):
            for k, (node, bit) in enumerate(way):
                nodes[k, b], bits[k, b] = node, bit
        return cls(nodes, bits, np.array([len(w) for w in ways]))


def _starts() -> np.ndarray:
    return np.concatenate([[0], np.cumsum([1 << b for b in BITS])]).astype(np.int64)


STARTS = _starts()
ODD = mix(np.arange(1, 16, dtype=np.uint64)) | np.uint64(1)


def contexts(keys: np.ndarray) -> list[np.ndarray]:
    """A hash of the context of each order; a key is the ``CONTEXT`` bytes before and the byte, the oldest lowest."""
    before = keys & np.uint64((1 << (8 * CONTEXT)) - 1)
    return [(before >> np.uint64(8 * (CONTEXT - k))) * ODD[i] + ODD[i + 5] for i, k in enumerate(ORDERS)]


def last_byte(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(8 * CONTEXT)).astype(np.uint8)


def slots(context: np.ndarray, node: np.ndarray, order: int) -> np.ndarray:
    """Places in the joined tables of all orders."""
    x = (context ^ (node.astype(np.uint64) * ODD[10])) * ODD[11]
    x = (x ^ (x >> np.uint64(29))) * ODD[12]
    return (x >> np.uint64(64 - BITS[order])).astype(np.int64) + STARTS[order]


def grouped(docs: Iterable[bytes], size: int = GROUP) -> Iterator[tuple[np.ndarray, list[tuple[int, int]]]]:
    """Keys of all bytes of normalized texts in groups of bounded size, with (text, bytes) for each piece in it."""
    held, pieces, total = [], [], 0

    def keys() -> np.ndarray:
        # A piece has the bytes before it in front; the last key is read as a word of eight bytes.
        found = [np.ndarray((n,), "<u8", p, 0, (1,)) for p, (_, n) in zip(held, pieces)]
        return np.concatenate(found) & np.uint64((1 << (8 * CONTEXT + 8)) - 1)

    for i, doc in enumerate(docs):
        for at in range(0, len(doc), PIECE):
            before = doc[at - CONTEXT : at] if at else b"\n" * CONTEXT
            piece = before + doc[at : at + PIECE]
            held.append(piece + b"\0" * (7 - CONTEXT))
            pieces.append((i, len(piece) - CONTEXT))
            total += pieces[-1][1]
            if total >= size:
                yield keys(), pieces
                held, pieces, total = [], [], 0
    if held:
        yield keys(), pieces


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each key among the different ones, and these."""
    return pd.factorize(keys)


class Remembered:
    """A value for each of the keys met last, one for each place that their hash has."""

    def __init__(self, kind: type):
        self.keys, self.values = np.full(1 << REMEMBERED, ~np.uint64(0)), np.zeros(1 << REMEMBERED, dtype=kind)

    def places(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * ODD[14]) >> np.uint64(64 - REMEMBERED)).astype(np.int64)


class Times(Remembered):
    """Counts keys; ``flush`` gets those that have to go, and all at the end, each with its count."""

    def __init__(self, flush):
        super().__init__(np.uint32)
        self.flush = flush

    def add(self, keys: np.ndarray) -> None:
        places = self.places(keys)
        known = self.keys[places] == keys
        np.add.at(self.values, places[known], np.uint32(1))
        which, found = distinct(keys[~known])
        times = np.bincount(which, minlength=len(found)).astype(np.uint32)
        places = self.places(found)
        old, old_times = self.keys[places], self.values[places]
        self.keys[places] = found
        stays = self.keys[places] == found  # of the keys that want one place the last has it
        self.values[places[stays]] = times[stays]
        gone = stays & (old_times > 0)
        self.flush(np.concatenate([found[~stays], old[gone]]), np.concatenate([times[~stays], old_times[gone]]))

    def close(self) -> None:
        held = np.flatnonzero(self.values)
        for at in range(0, len(held), 8 * STEP):
            self.flush(self.keys[held[at : at + 8 * STEP]], self.values[held[at : at + 8 * STEP]])


@dataclass
class Model:
    """Predictors as log odds by slot, how often the slots were met, the weights of the two gates, and the refinement."""

    code: ByteCode
    odds: np.ndarray
    met: np.ndarray
    by_met: np.ndarray = field(default_factory=lambda: np.full((16, len(ORDERS)), 0.15))
    by_node: np.ndarray = field(default_factory=lambda: np.full((256, len(ORDERS)), 0.15))
    refined: np.ndarray = field(default_factory=lambda: _centers())
    remembered: Remembered | None = None

    @classmethod
    def of(cls, code: ByteCode, counts: np.ndarray) -> Model:
        """From the counts of (slot, bit)."""
        odds, met = np.zeros(len(counts), dtype=np.float16), np.zeros(len(counts), dtype=np.uint8)
        for at in range(0, len(counts), 1 << 20):
            n = counts[at : at + (1 << 20)].astype(np.float32)
            odds[at : at + len(n)] = np.clip(np.log((n[:, 1] + 0.4) / (n[:, 0] + 0.4)), -LIMIT, LIMIT)
            met[at : at + len(n)] = np.digitize(n.sum(axis=1), [1, 3, 16])
        return cls(code, odds, met)

    def bits(self, keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each bit of the code of the last byte: rows that have it, the bit, predictions, gates."""
        byte, hashed = last_byte(keys), contexts(keys)
        rows = np.arange(len(keys))
        for k in range(len(self.code.nodes)):
            rows = rows[self.code.lengths[byte[rows]] > k]
            if len(rows) == 0:
                return
            node, bit = self.code.nodes[k, byte[rows]], self.code.bits[k, byte[rows]]
            places = [slots(h[rows], node, i) for i, h in enumerate(hashed)]
            odds = np.stack([self.odds[p] for p in places], axis=1).astype(np.float32)
            yield rows, bit, odds, self.met[places[-1]] * np.uint8(4) + self.met[places[-2]], node

    def mixed(self, odds: np.ndarray, met: np.ndarray, node: np.ndarray) -> np.ndarray:
        return np.clip(np.einsum("ij,ij->i", odds, (self.by_met[met] + self.by_node[node]).astype(np.float32)), -LIMIT * 1.5, LIMIT * 1.5)

    def log_probabilities(self, keys: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of the last byte of each key."""
        out = np.zeros(len(keys), dtype=np.float64)
        for at in range(0, len(keys), 4 * STEP):
            part = keys[at : at + 4 * STEP]
            total = np.zeros(len(part))
            for rows, bit, odds, met, node in self.bits(part):
                mixed = self.mixed(odds, met, node)
                low, share = _bucket(mixed)
                one = 0.5 / (1 + np.exp(-mixed)) + 0.5 * (self.refined[met, low] * (1 - share) + self.refined[met, low + 1] * share)
                total[rows] += np.log(np.where(bit == 1, one, 1 - one))
            out[at : at + len(part)] = total
        return out


    def remembered_logs(self, keys: np.ndarray) -> np.ndarray:
        """The same; keys that a task has met are not computed again."""
        if self.remembered is None:
            self.remembered = Remembered(np.float64)
        held = self.remembered
        places = held.places(keys)
        out = held.values[places]
        new = np.flatnonzero(held.keys[places] != keys)
        which, found = distinct(keys[new])
        out[new] = self.log_probabilities(found)[which]
        held.keys[places[new]] = keys[new]
        held.values[places[new]] = out[new]
        return out


def _centers() -> np.ndarray:
    """The refinement that changes nothing: the probability at each bucket, for each gate."""
    return np.tile(1 / (1 + np.exp(-np.linspace(-LIMIT * 1.5, LIMIT * 1.5, BUCKETS))), (16, 1))


def _bucket(mixed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = (mixed + LIMIT * 1.5) * ((BUCKETS - 1) / (LIMIT * 3))
    low = np.minimum(place.astype(np.int64), BUCKETS - 2)
    return low, place - low


def _gate_sums(gate: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.stack([np.bincount(gate, values[:, k], size) for k in range(values.shape[1])], axis=1)


def learn_weights(model: Model, docs: Iterable[bytes]) -> tuple[Model, np.ndarray, float]:
    """The model with the weights that one pass over texts leads to, (all, ones) of its refinement by gate and bucket, and the bits seen."""
    out = Model(model.code, model.odds, model.met, model.by_met.copy(), model.by_node.copy())
    squares = [np.full_like(out.by_met, 1e-6), np.full_like(out.by_node, 1e-6)]
    seen, total = np.zeros((2, 16, BUCKETS)), 0.0
    for keys, _ in grouped(docs):
        which, found = distinct(keys)
        times = np.bincount(which, minlength=len(found)).astype(np.float64)
        # Frequent keys come first in the texts; every step shall see some of all.
        mixed_up = np.argsort(mix(found.astype(np.uint64)))
        found, times = found[mixed_up], times[mixed_up]
        for at in range(0, len(found), LEARN_STEP):
            part, weight = found[at : at + LEARN_STEP], times[at : at + LEARN_STEP]
            for rows, bit, odds, met, node in out.bits(part):
                mixed = out.mixed(odds, met, node)
                n = weight[rows]
                low, share = _bucket(mixed)
                for place, amount in ((low, n * (1 - share)), (low + 1, n * share)):
                    np.add.at(seen[0], (met, place), amount)
                    np.add.at(seen[1], (met, place), amount * bit)
                total += float(n.sum())
                gradient = odds * (n * (bit - 1 / (1 + np.exp(-mixed))))[:, None]
                for gate, weights, square in ((met, out.by_met, squares[0]), (node, out.by_node, squares[1])):
                    step = _gate_sums(gate, gradient, len(weights)) / (np.bincount(gate, n, len(weights)) + 1e-9)[:, None]
                    square += step**2
                    weights += RATE * step / np.sqrt(square)
    return out, seen, total


def _count_tokens(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, item, n): of kind 0 how often a token hash, of kind 1 how often a byte occurs in the texts."""
    bytes_ = np.zeros(256, dtype=np.int64)
    for batch in in_pieces(batches, 1024):
        docs = [normalized(d) for d in texts(batch.column("text"))]
        tokens, counts = np.unique(token_hashes(docs)[0], return_counts=True)
        for d in docs:
            bytes_ += np.bincount(np.frombuffer(d, dtype=np.uint8), minlength=256)
        yield _token_rows(0, tokens.view(np.int64), counts)
    yield _token_rows(1, np.arange(256), bytes_)


def _token_rows(kind: int, items: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(items), kind, dtype=np.int32)), pa.array(items, pa.int64()), pa.array(counts, pa.int64())], names=["kind", "item", "n"])


def _count_contexts(batches: Iterable[pa.RecordBatch], code: ByteCode) -> Iterator[pa.RecordBatch]:
    """(tuning, chunk, counts): how often bits of 0 and 1 came in each slot, for each fold, packed chunk by chunk."""
    counts = np.zeros((2, 2 * STARTS[-1]), dtype=np.uint32)
    folds = [Times(lambda keys, times, of=of: _add_contexts(of, code, keys, times)) for of in counts]
    for batch in batches:
        tuning = batch.column("tuning").to_numpy(zero_copy_only=False)
        docs = list(texts(batch.column("text")))
        for fold, held in enumerate(folds):
            for keys, _ in grouped(normalized(d) for d, t in zip(docs, tuning) if t == fold):
                held.add(keys)
    for held in folds:
        held.close()
    pack = zstandard.ZstdCompressor(level=1).compress
    for fold in (0, 1):
        chunks = counts[fold].reshape(-1, 2 * CHUNK)
        met = np.flatnonzero(chunks.any(axis=1))
        for at in range(0, len(met), 64):
            some = met[at : at + 64]
            packed = [pack(chunks[c].tobytes()) for c in some]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), fold, dtype=np.int32)), pa.array(some, pa.int64()), pa.array(packed, pa.binary())], names=["tuning", "chunk", "counts"])


def _add_contexts(counts: np.ndarray, code: ByteCode, keys: np.ndarray, times: np.ndarray) -> None:
    byte, hashed = last_byte(keys), contexts(keys)
    rows = np.arange(len(keys))
    for k in range(len(code.nodes)):
        rows = rows[code.lengths[byte[rows]] > k]
        if len(rows) == 0:
            return
        node, bit = code.nodes[k, byte[rows]], code.bits[k, byte[rows]].astype(np.int64)
        for i, h in enumerate(hashed):
            np.add.at(counts, 2 * slots(h[rows], node, i) + bit, times[rows])


def _sum_chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each (tuning, chunk) of rows sorted by them; counts as longs."""
    unpack, last, total = zstandard.ZstdDecompressor().decompress, None, None

    def row() -> pa.RecordBatch:
        packed = zstandard.ZstdCompressor(level=1).compress(total.tobytes())
        return pa.RecordBatch.from_arrays([pa.array([last[0]], pa.int32()), pa.array([last[1]], pa.int64()), pa.array([packed], pa.binary())], names=["tuning", "chunk", "counts"])

    for batch in batches:
        for tuning, chunk, counts in zip(*(c.to_pylist() for c in batch.columns)):
            if (tuning, chunk) != last:
                if last is not None:
                    yield row()
                last, total = (tuning, chunk), np.zeros(2 * CHUNK, dtype=np.int64)
            total += np.frombuffer(unpack(counts), dtype=np.uint32)
    if last is not None:
        yield row()


def _learn(batches: Iterable[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """(name, place, total, n): weights by gate and refinement, to be added up over all tasks."""
    learned, seen, bits = learn_weights(model, (normalized(d) for batch in batches for d in texts(batch.column("text"))))
    if bits:
        for name, values, n in (("met", learned.by_met * bits, bits), ("node", learned.by_node * bits, bits), ("seen", seen[0], 0.0), ("ones", seen[1], 0.0)):
            flat = values.reshape(-1)
            columns = [pa.array([name] * len(flat)), pa.array(np.arange(len(flat))), pa.array(flat), pa.array(np.full(len(flat), n))]
            yield pa.RecordBatch.from_arrays(columns, names=["name", "place", "total", "n"])


@dataclass
class LanguageModel:
    """The byte model, and the counts (item, n) of all training tokens with their total and the number of distinct ones."""

    model: Model
    tokens: DataFrame
    n_tokens: int
    n_distinct: int


def _counts(rows: list, tuning: Iterable[int]) -> np.ndarray:
    out = np.zeros(2 * STARTS[-1], dtype=np.int64)
    unpack = zstandard.ZstdDecompressor().decompress
    for r in rows:
        if r["tuning"] in tuning:
            out[2 * CHUNK * r["chunk"] : 2 * CHUNK * (r["chunk"] + 1)] += np.frombuffer(unpack(r["counts"]), dtype=np.int64)
    return out.reshape(-1, 2)


def fit(docs: DataFrame, text: str = "text", tuning: str | None = None) -> LanguageModel:
    """A model of all texts of ``docs``; rows in which ``tuning`` is true teach the weights before they are counted."""
    of = F.col(f"`{tuning}`") if tuning else F.lit(False)
    docs = docs.select(F.col(f"`{text}`").alias("text"), F.coalesce(of, F.lit(False)).cast("int").alias("tuning"))
    tokens = docs.select("text").mapInArrow(_count_tokens, "kind int, item bigint, n bigint").groupBy("kind", "item").agg(F.sum("n").alias("n"))
    tokens = staged(tokens, "lm_tokens")
    bytes_ = np.zeros(256, dtype=np.int64)
    for r in tokens.where("kind = 1").collect():  # one row for each byte value
        bytes_[r["item"]] = r["n"]
    tokens = tokens.where("kind = 0").select("item", "n")
    size = tokens.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    code = ByteCode.of(bytes_)

    counted = docs.mapInArrow(lambda batches: _count_contexts(batches, code), "tuning int, chunk bigint, counts binary")
    counted = counted.repartition("tuning", "chunk").sortWithinPartitions("tuning", "chunk").mapInArrow(_sum_chunks, "tuning int, chunk bigint, counts binary")
    rows = counted.collect()  # the tables, whose size is fixed by BITS
    model = Model.of(code, _counts(rows, (0,)))
    learned = docs.where("tuning = 1").select("text").mapInArrow(lambda batches: _learn(batches, model), "name string, place bigint, total double, n double")
    sums = learned.groupBy("name", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()  # weights and buckets
    parts = {name: {r["place"]: (r["total"], r["n"]) for r in sums if r["name"] == name} for name in ("met", "node", "seen", "ones")}
    final = Model.of(code, _counts(rows, (0, 1)))
    for name, weights in (("met", final.by_met), ("node", final.by_node)):
        for place, (total, n) in parts[name].items():
            weights.reshape(-1)[place] = total / n
    seen, ones = (np.zeros((16, BUCKETS)) for _ in range(2))
    for name, values in (("seen", seen), ("ones", ones)):
        for place, (total, _) in parts[name].items():
            values.reshape(-1)[place] = total
    final.refined = (ones + 16 * final.refined) / (seen + 16)
    return LanguageModel(final, tokens, size["n"] or 0, size["v"])


def token_logs(model: Model, docs: list[bytes]) -> list[np.ndarray]:
    """For each normalized text the natural logarithms of the byte model's probabilities of its tokens."""
    out: list[list[np.ndarray]] = [[] for _ in docs]
    open_ = np.zeros(len(docs))
    for keys, pieces in grouped(docs):
        logs = model.remembered_logs(keys)
        byte = last_byte(keys)
        ends = np.flatnonzero((byte == SPACE_BYTE) | (byte == END_BYTE))
        at = 0
        for doc, size in pieces:
            own = ends[np.searchsorted(ends, at) : np.searchsorted(ends, at + size)]
            starts = np.r_[0, own + 1 - at]
            sums = np.add.reduceat(logs[at : at + size], starts[starts < size])
            sums[0] += open_[doc]
            open_[doc] = sums[-1] if len(sums) > len(own) else 0.0
            out[doc].append(sums[: len(own)])
            at += size
    return [np.concatenate(parts) for parts in out]


def text_score(by_bytes: np.ndarray, counts: np.ndarray, n: int, v: int) -> tuple[float, float]:
    """(base, score) in decimal logarithms of a text from the byte model's logarithms and the counts of its tokens."""
    by_count = np.log(counts + 0.5) - np.log(n + 0.5 * (v + 1))
    gain = np.exp(np.minimum(np.where(counts > 0, by_count - by_bytes, by_count), 600))
    sums = np.array([by_bytes.sum() + np.log1p(share * (gain - 1)).sum() for share in SHARES])
    best = sums.max()
    return by_count.sum() / np.log(10), (best + np.log(np.exp(sums - best).mean())) / np.log(10)


def _score(docs: pa.Table, found: pa.Table, model: Model, n: int, v: int) -> pa.Table:
    items, counts = found.column("item").to_numpy(), found.column("n").to_numpy()
    order = np.argsort(items)
    items, counts = items[order], counts[order]
    bases, scores, sizes, known = [], [], [], []
    for batch in docs.to_batches(max_chunksize=1024):
        normal = [normalized(d) for d in texts(batch.column("text"))]
        tokens, lengths = token_hashes(normal)
        tokens = tokens.view(np.int64)
        place = np.minimum(np.searchsorted(items, tokens), len(items) - 1)
        if not (items[place] == tokens).all():
            raise ValueError("the tokens of a text are not those of its block: its rows were dealt in another way before")
        for logs, of in zip(token_logs(model, normal), np.split(counts[place], np.cumsum(lengths)[:-1])):
            base, score = text_score(logs, of, n, v)
            bases.append(base)
            scores.append(score)
            sizes.append(len(of))
            known.append(int((of > 0).sum()))
    return pa.table({"row": docs.column("row"), "n_tokens": pa.array(sizes, pa.int64()), "n_known": pa.array(known, pa.int64()), "base_score": pa.array(bases, pa.float64()), "score": pa.array(scores, pa.float64())})


def _block_tokens(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, item): the distinct tokens of each block, of rows in any order; a batch is one step."""
    met: dict[int, np.ndarray] = {}
    for batch in in_pieces(batches, 4096):
        tokens, lengths = token_hashes([normalized(d) for d in texts(batch.column("text"))])
        blocks = np.repeat(batch.column("block").to_numpy(), lengths)
        for block in np.unique(blocks):
            new = pd.unique(tokens[blocks == block])
            met[int(block)] = pd.unique(np.concatenate([met[int(block)], new])) if int(block) in met else new
    for block, items in met.items():
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(items), block, dtype=np.int64)), pa.array(items.view(np.int64))], names=["block", "item"])


def score(docs: DataFrame, lm: LanguageModel, text: str = "text", block: int = BLOCK) -> DataFrame:
    """The columns of ``docs`` without the text, and n_tokens, n_known, train_tokens, base_score and score, which replace columns of that name."""
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`"))).alias("n")).first()["n"] or 0
    given = [c for c in docs.columns if c not in (text, "n_tokens", "n_known", "train_tokens", "base_score", "score")]
    row = F.struct(*(F.col(f"`{c}`") for c in given)).alias("row")
    rows = docs.select(row, F.col(f"`{text}`").alias("text"))
    blocks = max(1, -(-size // block))
    # Equal rows get numbers of their own, or a third of all rows could be one block.
    rows = rows.withColumn("block", F.pmod(F.xxhash64("row", "text", F.monotonically_increasing_id()), F.lit(blocks)))
    # No fewer partitions than an exchange has by itself, or the texts would be dealt again to meet their tokens.
    rows = rows.repartition(max(blocks, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "block")
    met = rows.mapInArrow(_block_tokens, "block bigint, item bigint").join(lm.tokens, "item", "left").select("block", "item", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))
    model, n, v = lm.model, lm.n_tokens, lm.n_distinct
    added = [StructField(c, LongType()) for c in ("n_tokens", "n_known")] + [StructField(c, DoubleType()) for c in ("base_score", "score")]
    schema = StructType([rows.schema["row"], *added])
    found = rows.groupBy("block").cogroup(met.groupBy("block")).applyInArrow(lambda docs, tokens: _score(docs, tokens, model, n, v), schema)
    return found.select(*(F.col(f"row.`{c}`") for c in given), "n_tokens", "n_known", F.lit(n).cast("bigint").alias("train_tokens"), "base_score", "score")


def op13_lm_score(spark, sf_dir: str) -> DataFrame:
    """The probability of every document by a model of four fifths of them."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"), (fold == TUNING_FOLD).alias("tuning"))
    lm = fit(docs.where("NOT held_out"), tuning="tuning")
    out = score(docs.drop("tuning"), lm)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
