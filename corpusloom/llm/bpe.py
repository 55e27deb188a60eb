"""Byte-level BPE encoding and decoding with a pair occurrence index.

The words of a batch that are new to the task are laid end to end as byte symbols. An index maps each
pair of neighbours to all positions where it stands; pairs are taken by ascending merge rank, all
occurrences of one pair are merged at once, and the positions next to them enter the index under
their new pairs. Words of different documents share this work, and ids of words that came before are
kept in a dictionary of bounded size.

Null texts encode and decode like empty ones; texts are read whole whatever their length; repeated
rows get equal results; an empty table gives an empty table. Columns of the input are kept; result
columns replace input columns of the same name.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
import sys
import types
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corpusloom.llm.common import in_pieces, table

#: How words are cut out of a text; a fixed value of this kind of vocabulary.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE_ENTRIES = 300_000
CACHE_WORD = 64  # longer words are encoded anew each time


def worker_cache(name: str) -> dict:
    """A dictionary that outlives a task in its Python worker, until a step asks for one of another name.

    Spark reuses workers for many tasks and steps; only one step's dictionary is held at a time.
    """
    holder = sys.modules.setdefault("_corpusloom_worker_cache", types.ModuleType("_corpusloom_worker_cache"))
    kept = holder.__dict__.setdefault("kept", {})
    for other in [k for k in kept if k != name]:
        del kept[other]
    return kept.setdefault(name, {})


class Recent:
    """Values of recent keys in two dictionaries of bounded size; keys in use move to the newer one."""

    def __init__(self, entries: int):
        self.entries, self.now, self.old = entries, {}, {}

    def turn(self) -> None:
        """Lets the older half go when the newer one is full; for the start of a batch."""
        if len(self.now) > self.entries:
            self.old, self.now = self.now, {}

    def missing(self, keys: set) -> list:
        """Those of the keys that have no value; all others are in ``now`` afterwards."""
        now, old = self.now, self.old
        out = []
        for k in keys.difference(now):
            if k in old:
                now[k] = old[k]
            else:
                out.append(k)
        return out

    def forget(self, keys: Iterable, longest: int) -> None:
        """Lets keys go that are too long to keep; for the end of a batch."""
        for k in keys:
            if len(k) > longest:
                self.now.pop(k, None)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: itself if it prints in Latin-1, else the next free one from 256 on."""
    prints = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(prints)]
    return {chr(b): b for b in prints} | {chr(256 + k): b for k, b in enumerate(others)}


class PairIndexBpe:
    """A vocabulary with its merges; ``encode`` works on many words at once."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_at = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.byte_id = np.zeros(256, dtype=np.int64)
        for letter, b in letters.items():
            self.byte_id[b] = vocab[letter]
        left = np.array([vocab[a] for a, _ in merges], dtype=np.int64)
        right = np.array([vocab[b] for _, b in merges], dtype=np.int64)
        self.left, self.right = left, right
        self.made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        key = (left << 32) | right
        self.order = np.argsort(key, kind="stable")
        self.keys = key[self.order]
        self.word = regex.compile(WORDS)

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, -1 for pairs that never merge."""
        key = (a << 32) | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], -1)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian bytes; words must not be empty."""
        if not words:
            return []
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(lengths)
        starts = ends - lengths
        n = int(ends[-1])
        sym = np.append(self.byte_id[np.frombuffer(b"".join(words), dtype=np.uint8)], -1)
        after = np.arange(1, n + 2, dtype=np.int64)
        after[ends - 1] = n
        before = np.arange(-1, n, dtype=np.int64)
        before[starts] = n
        occurrences: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(places: np.ndarray) -> None:
            ranks = self._ranks(sym[places], sym[after[places]])
            known = ranks >= 0
            places, ranks = places[known], ranks[known]
            if len(places) == 0:
                return
            by_rank = np.argsort(ranks, kind="stable")
            places, ranks = places[by_rank], ranks[by_rank]
            cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
            for begin, end, rank in zip(cuts, cuts[1:], ranks[cuts[:-1]].tolist()):
                group = places[begin:end]
                if rank in occurrences:
                    occurrences[rank].append(group)
                else:
                    occurrences[rank] = [group]
                    heapq.heappush(active, rank)

        first = np.arange(n, dtype=np.int64)
        enter(first[after[:n] < n])
        while active:
            rank = heapq.heappop(active)
            groups = occurrences.pop(rank)
            a, b = self.left[rank], self.right[rank]
            places = distinct(np.concatenate(groups)) if len(groups) > 1 else groups[0]
            places = places[(sym[places] == a) & (sym[after[places]] == b)]
            if len(places) == 0:
                continue
            if a == b:  # in a run of equal symbols, every second pair from the left
                joined = np.r_[False, after[places[:-1]] == places[1:]]
                at = np.arange(len(places))
                run = at - np.maximum.accumulate(np.where(joined, 0, at))
                places = places[run % 2 == 0]
            gone = after[places]
            sym[places] = self.made[rank]
            sym[gone] = -2
            behind = after[gone]
            after[places] = behind
            before[behind] = places
            ahead = before[places]
            enter(distinct(np.concatenate((ahead[ahead < n], places[behind < n]))))
        alive = sym[:n] >= 0
        ids = sym[:n][alive].astype("<u4").tobytes()
        ends = (4 * np.cumsum(np.add.reduceat(alive, starts, dtype=np.int64))).tolist()
        return [ids[begin:end] for begin, end in zip([0, *ends], ends)]


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted, without repeats; sorts in place."""
    if len(x) < 2:
        return x
    x.sort()
    keep = np.empty(len(x), dtype=bool)
    keep[0] = True
    np.not_equal(x[1:], x[:-1], out=keep[1:])
    return x[keep]


#: A blank beside other white space or at an end of the text.
ODD_BLANK = re.compile(r"\s | \s|\A | \Z")


class Encoder:
    """Texts to ids as little-endian bytes, with bounded dictionaries of what came before."""

    def __init__(self, path: str):
        kept = worker_cache(f"bpe:{path}")
        if "model" not in kept:
            kept["model"], kept["parts"], kept["words"] = PairIndexBpe(path), Recent(CACHE_ENTRIES), Recent(CACHE_ENTRIES)
        self.model, self.parts, self.words = kept["model"], kept["parts"], kept["words"]

    def _spans(self, text: str) -> list[tuple[str, str]]:
        """Runs of ordinary text, and special tokens with their name."""
        if self.model.special_at is None or not self.model.special_at.search(text):
            return [(text, "")]
        out, at = [], 0
        for m in self.model.special_at.finditer(text):
            out += [(text[at : m.start()], ""), ("", m.group())]
            at = m.end()
        return [*out, (text[at:], "")]

    def _cut(self, text: str) -> tuple[list[str], list[str]]:
        """Words at the start, and parts that each stand behind one blank; no word crosses their limits."""
        if ODD_BLANK.search(text):
            return self.model.word.findall(text), []
        first, *parts = text.split(" ")
        return self.model.word.findall(first), parts

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        model = self.model
        self.parts.turn()
        self.words.turn()
        spans = [[(*self._cut(t), special) for t, special in self._spans(text)] for text in texts]
        new = self.parts.missing(set().union(*(parts for row in spans for _, parts, _ in row)))
        cut = {p: model.word.findall(" " + p) for p in new}
        fresh = self.words.missing(set().union(*(words for row in spans for words, _, _ in row), *cut.values()))
        self.words.now.update(zip(fresh, model.encode([w.encode() for w in fresh])))
        of_word, of_part = self.words.now.__getitem__, self.parts.now.__getitem__
        self.parts.now.update((p, b"".join(map(of_word, words))) for p, words in cut.items())
        out = []
        for row in spans:
            ids = []
            for words, parts, special in row:
                ids += map(of_word, words)
                ids += map(of_part, parts)
                if special:
                    ids.append(np.uint32(model.special[special]).tobytes())
            out.append(b"".join(ids))
        self.words.forget(fresh, CACHE_WORD)
        self.parts.forget(new, CACHE_WORD)
        return out


def text_groups(batch: pa.RecordBatch, text: str, chars: int = 4_000_000) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a batch with about ``chars`` characters at most, or one longer text."""
    column, start, held, size = batch.column(text), 0, [], 0
    for at in range(batch.num_rows):
        x = column[at].as_py() or ""
        if held and size + len(x) > chars:
            yield batch.slice(start, len(held)), held
            start, held, size = at, [], 0
        held.append(x)
        size += len(x)
    if held:
        yield batch.slice(start, len(held)), held


def _int_lists(rows: list[bytes]) -> pa.Array:
    lengths = np.fromiter((len(r) // 4 for r in rows), dtype=np.int64, count=len(rows))
    values = np.frombuffer(b"".join(rows), dtype="<i4")
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths)].astype(np.int32)), pa.array(values, pa.int32()))


def _replaced(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    kept = {n: batch.column(n) for n in batch.schema.names if n not in columns}
    return pa.RecordBatch.from_pydict(kept | columns)


def encode_batches(batches: Iterable[pa.RecordBatch], path: str, text: str, to: str) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(path)
    for batch in in_pieces(batches, 2048):
        for part, texts in text_groups(batch, text):
            yield _replaced(part, **{to: _int_lists(encoder.encode_batch(texts))})


def decode_batches(batches: Iterable[pa.RecordBatch], path: str, ids: str, to: str) -> Iterator[pa.RecordBatch]:
    """Ids to text; bytes that are no UTF-8 become U+FFFD. Null ids give an empty text."""
    bytes_of = Encoder(path).model.bytes_of
    for batch in in_pieces(batches, 2048):
        lists = batch.column(ids)
        out = []
        for row in lists:
            values = row.values.to_numpy().tolist() if row.is_valid else []
            out.append(b"".join([bytes_of[i] for i in values]).decode("utf-8", "replace"))
        yield _replaced(batch, **{to: pa.array(out, pa.string())})


def encode(df: DataFrame, path: str, text: str = "text", to: str = "ids") -> DataFrame:
    """Adds the ids of each text as ``array<int>``."""
    schema = T.StructType([f for f in df.schema if f.name != to] + [T.StructField(to, T.ArrayType(T.IntegerType()))])
    return df.mapInArrow(lambda batches: encode_batches(batches, path, text, to), schema)


def decode(df: DataFrame, path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """Adds the text of each list of ids."""
    schema = T.StructType([f for f in df.schema if f.name != to] + [T.StructField(to, T.StringType())])
    return df.mapInArrow(lambda batches: decode_batches(batches, path, ids, to), schema)


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = [r.values.to_numpy().astype("<u4").tobytes() for r in batch.column("ids")]
        decoded = [x.as_py().encode() for x in batch.column("decoded")]
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string()),
            }
        )


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))


def op8_bpe(spark, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document and of their decoded text; one Python step, no shuffle."""
    path = tokenizer_path("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")

    def run(batches):
        encoded = encode_batches(batches, path, "text", "ids")
        return _digests(decode_batches(encoded, path, "ids", "decoded"))

    return docs.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
