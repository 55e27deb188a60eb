"""Sum-of-squares packing of token sequences.

Documents longer than a sequence are cut into full pieces and a rest. A full piece is a sequence of its
own. All other pieces are dealt to partitions by a hash of their place; a partition places them one
after the other, longest first, where the sum over all gaps of the squared number of open sequences
with that gap becomes smallest: into an open sequence or a new one. Sequences that stay ``LOOSE`` tokens short or more, those
at the ends of all partitions among them, are then emptied and their pieces placed once more, longest first, each where it
fits best, if that takes fewer. Only piece lengths are shuffled.

A null text counts as an empty one, which is one piece with the end id alone. Equal pieces are told
apart by their place, so repeated rows are all packed; an empty table gives an empty table.
"""

from __future__ import annotations

import bisect
import os
import struct
import unicodedata
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.bpe import Recent, byte_letters, text_groups, tokenizer_path, worker_cache
from corpusloom.llm.common import in_pieces, staged, table

SIZE = 2048
END_ID = 0
PARTITION_PIECES = 16_384
LOOSE = 8
CACHE_ENTRIES = 350_000
GROUP_CHARS = 1_000_000
CACHE_WORD = 48
WORD_END = "</w>"  # how the vocabulary marks the last token of a word


def _is_letter(char: str) -> bool:
    """Whether the tokenizer's lower case of a letter ends in one: that of some ends in a mark, which a full stop would join."""
    return char.isalpha() and (char.isascii() or unicodedata.normalize("NFC", char).lower()[-1].isalpha())


#: The letters that byte-level models have for bytes.
LETTERS = {b: ord(letter) for letter, b in byte_letters().items()}


class WordIds:
    """Ids of texts by a tokenizer that drops white space, so that no token crosses a blank.

    Blank-separated parts are encoded by the tokenizer once and kept, up to a bound. A mark at the end
    of a part that follows a letter is a part of its own.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        kept = worker_cache(f"words:{path}")
        if "tokenizer" not in kept:
            made = Tokenizer.from_file(path)
            made.no_truncation()
            made.no_padding()
            ends = np.zeros(made.get_vocab_size(), dtype=bool)
            ends[[i for token, i in made.get_vocab().items() if token.endswith(WORD_END)]] = True
            kept["tokenizer"], kept["word_end"], kept["ids"] = made, ends, Recent(CACHE_ENTRIES)
        self.tokenizer, self.word_end, self.ids = kept["tokenizer"], kept["word_end"], kept["ids"]

    @staticmethod
    def _base(part: str) -> tuple[str, str]:
        """The part to look up, and a mark behind it; A-Z and a-z are the same to the tokenizer."""
        mark = ""
        if part[-1] in ".," and len(part) > 1 and _is_letter(part[-2]):
            part, mark = part[:-1], part[-1]
        return (part.lower() if part.isascii() and "<|" not in part else part), mark

    def _tokenized(self, words: list[str]) -> dict[str, bytes]:
        """Ids by the tokenizer. Words of letters alone are one word to it: those of Latin-1 go to its model as they stand there,
        the others are encoded many in one text and told apart by the ids that end a word."""
        got, plain, others = {}, [], []
        tokenize, pack = self.tokenizer.model.tokenize, struct.pack
        for w in words:
            if not w.isalpha():
                others.append(w)
            elif w.isascii():
                found = [t.id for t in tokenize(w.lower())]
                got[w] = pack(f"<{len(found)}I", *found)
            elif max(w) <= "\xff":
                found = [t.id for t in tokenize(w.lower().encode().decode("latin-1").translate(LETTERS))]
                got[w] = pack(f"<{len(found)}I", *found)
            else:
                plain.append(w)
        for at in range(0, len(plain), 4096):
            own = plain[at : at + 4096]
            ids = np.array(self.tokenizer.encode(" ".join(own), add_special_tokens=False).ids, dtype="<u4")
            ends = np.flatnonzero(self.word_end[ids]) + 1
            if len(ends) != len(own):
                others += own
                continue
            cuts, raw = (4 * ends).tolist(), ids.tobytes()
            got.update((w, raw[a:b]) for w, a, b in zip(own, [0, *cuts], cuts))
        encoded = self.tokenizer.encode_batch(others, add_special_tokens=False)
        got.update((w, np.array(e.ids, dtype="<u4").tobytes()) for w, e in zip(others, encoded))
        return got

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        self.ids.turn()
        rows = [t.replace("\n", " ").split(" ") for t in texts]
        new = self.ids.missing(set().union(*rows))
        # Most new parts are words in lower case already; the others are made of a word and a mark.
        direct = {p for p in new if p.isascii() and p.isalpha() and p.islower()}
        bases = {p: self._base(p) if p else ("", "") for p in new if p not in direct}
        fresh = [*direct, *self.ids.missing(set().union(*bases.values()) - direct)]
        self.ids.now.update(self._tokenized(fresh))
        of = self.ids.now.__getitem__
        self.ids.now.update([(p, of(base) + of(mark)) for p, (base, mark) in bases.items()])
        out = [b"".join(map(of, row)) for row in rows]
        self.ids.forget(fresh, CACHE_WORD)
        self.ids.forget(new, CACHE_WORD)
        return out


def piece_batches(batches: Iterable[pa.RecordBatch], path: str, size: int) -> Iterator[pa.RecordBatch]:
    words = WordIds(path)
    end = np.uint32(END_ID).tobytes()
    for batch in in_pieces(batches, 2048):
        for part, texts in text_groups(batch, "text", GROUP_CHARS):
            row, piece, start, length, crc = [], [], [], [], []
            for at, ids in enumerate(words.encode_batch(texts)):
                ids += end
                for k, begin in enumerate(range(0, len(ids), 4 * size)):
                    own = ids[begin : begin + 4 * size]
                    row.append(at)
                    piece.append(k)
                    start.append(begin // 4)
                    length.append(len(own) // 4)
                    crc.append(zlib.crc32(own))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": part.column("doc_id").take(pa.array(row, pa.int64())),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()),
                }
            )


def pieces(df: DataFrame, path: str, size: int = SIZE) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of all texts, the end id included."""
    return df.select("doc_id", "text").mapInArrow(
        lambda batches: piece_batches(batches, path, size), "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    )


def place(lengths: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each item, in the order given, by the sum-of-squares rule."""
    count = np.zeros(size + 1, dtype=np.int64)  # open sequences by gap
    open_by_gap: list[list[int]] = [[] for _ in range(size + 1)]
    used = 0
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    change = np.empty(size + 1, dtype=np.int64)
    big = np.iinfo(np.int64).max
    for i, n in enumerate(lengths.tolist()):
        # For each gap: by how much half the sum of squares changes; a full sequence has no gap.
        fits = change[n:]
        np.subtract(count[: size + 1 - n], count[n:], out=fits)
        fits *= 2
        fits += 2
        fits[0] = 1 - 2 * count[n]
        fits[count[n:] == 0] = big
        best = int(fits.argmin()) + n
        new = 2 * count[size - n] + 1 if n < size else 0
        if change[best] <= new:
            b, gap = open_by_gap[best].pop(), best
            count[best] -= 1
        else:
            b, gap = used, size
            used += 1
        bins[i], offsets[i] = b, size - gap
        left = gap - n
        if left:
            count[left] += 1
            open_by_gap[left].append(b)
    return bins, offsets


def best_fit(lengths: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each item, in the order given, each in the fullest sequence that has room."""
    open_: list[tuple[int, int]] = []  # (gap, sequence), sorted
    used = 0
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    for i, n in enumerate(lengths.tolist()):
        at = bisect.bisect_left(open_, (n, -1))
        if at < len(open_):
            gap, b = open_.pop(at)
        else:
            gap, b = size, used
            used += 1
        bins[i], offsets[i] = b, size - gap
        if gap > n:
            bisect.insort(open_, (gap - n, b))
    return bins, offsets


def pack(found: DataFrame, size: int = SIZE, partition_pieces: int = PARTITION_PIECES) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to staged pieces; all other input columns are kept, but for those that start with ``_pack_``."""
    kept = [c for c in found.columns if c not in ("sequence_id", "offset") and not c.startswith("_pack_")]
    found = found.select(*(F.col(f"`{c}`") for c in kept), F.monotonically_increasing_id().alias("_pack_place"))
    full, rest = found.where(F.col("length") == size), found.where(F.col("length") < size)
    n = rest.count()
    rest = rest.withColumn("_pack_part", F.pmod(F.xxhash64("_pack_place"), F.lit(max(1, -(-n // partition_pieces)))))

    def of_part(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "_pack_place"], ascending=[False, True])
        lengths = rows["length"].to_numpy()
        bins, offsets = place(lengths, size)
        # Odd numbers, so that none is that of a full piece.
        rows["sequence_id"] = (rows["_pack_part"] * (1 << 40) + bins) * 2 + 1
        rows["offset"] = offsets
        rows["_pack_gap"] = size - np.bincount(bins, lengths).astype(np.int64)[bins]
        return rows

    def of_loose(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "_pack_place"], ascending=[False, True])
        bins, offsets = best_fit(rows["length"].to_numpy(), size)
        before = np.sort(rows["sequence_id"].unique())
        if bins.max() + 1 < len(before):
            rows["sequence_id"], rows["offset"] = before[bins], offsets
        return rows

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema), "sequence_id bigint", "offset bigint", "_pack_gap bigint"])
    first = staged(rest.groupBy("_pack_part").applyInPandas(of_part, schema), "first_packing")
    # Whole sequences go to a group, so a group is never worse than before.
    loose = first.where(F.col("_pack_gap") >= LOOSE)
    groups = max(1, -(-loose.count() // partition_pieces))
    loose = loose.withColumn("_pack_part", F.pmod(F.xxhash64("sequence_id"), F.lit(groups)))
    again = loose.groupBy("_pack_part").applyInPandas(of_loose, schema)
    alone = full.withColumn("sequence_id", F.col("_pack_place") * 2).withColumn("offset", F.lit(0).cast("bigint"))
    columns = [*(f"`{c}`" for c in kept), "sequence_id", "offset"]
    return first.where(F.col("_pack_gap") < LOOSE).select(*columns).unionByName(again.select(*columns)).unionByName(alone.select(*columns))


def pack_documents(df: DataFrame, path: str, size: int = SIZE) -> DataFrame:
    """All pieces of all documents with their sequence and place; pieces are staged, so tokens are made once."""
    return pack(staged(pieces(df, path, size), "pieces"), size)


def op6_packing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"))
