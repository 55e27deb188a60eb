"""Segmentation of whole texts by scored pieces: of all ways to cut a text into pieces, the one with the largest sum of scores.

The pieces are a trie over code points. All positions of a batch of texts walk down it together, which gives every piece at
every place; the best path is then found from left to right for all stretches of the batch at once, a step for each place in
the longest one. If no piece holds a blank but at its begin, a path can be cut before every blank, so stretches are words,
and of a text that is longer than a group some words are taken at a time; else stretches are texts. Either way a text is taken
whole, whatever its length.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame

from corpusloom.functions.text import grouped
from corpusloom.operators.encode import encode_with

#: Pieces that tasks get as a dictionary.
MAX_PIECES = 1_000_000
SPACE_MARK = "▁"
#: Characters that walk down the trie together, which bounds the working memory of a task: it is some hundred bytes for each.
GROUP_CHARS = 1 << 17
_CODE_BITS = 21
#: How much less than the worst piece an unknown character scores.
UNKNOWN = 10.0


class Segmenter:
    """Ids of the best pieces of texts. Pieces are {piece: (id, score)}; blanks in them are written as ``SPACE_MARK``.

    A character that is no piece is one unknown piece. Of equal paths the one whose last piece is longest wins, at each place.
    """

    def __init__(self, pieces: Mapping[str, tuple[int, float]], unk_id: int = 0):
        children: dict[int, int] = {}
        ids, scores = [-1], [0.0]
        whole = True
        for piece, (piece_id, score) in pieces.items():
            text = piece.replace(SPACE_MARK, " ")
            if not text:
                raise ValueError("a piece must not be empty")
            whole &= " " not in text[1:]
            node = 0
            for char in text:
                key = node << _CODE_BITS | ord(char)
                if key not in children:
                    children[key] = len(ids)
                    ids.append(-1)
                    scores.append(0.0)
                node = children[key]
            ids[node], scores[node] = piece_id, score
        self.keys = np.array(sorted(children), dtype=np.int64)
        self.children = np.array([children[k] for k in self.keys.tolist()], dtype=np.int64)
        self.ids, self.scores = np.array(ids, dtype=np.int64), np.array(scores, dtype=np.float64)
        self.unk_id, self.by_word = unk_id, whole
        self.unknown = min([s for _, s in pieces.values()], default=0.0) - UNKNOWN

    def _edges(self, codes: np.ndarray, behind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, id, score) of every piece at every place; ``behind`` is the end of the stretch of each place."""
        n = len(codes)
        starts, nodes, depth = np.arange(n), np.zeros(n, dtype=np.int64), 0
        found: list[tuple] = []
        alone = np.ones(n, dtype=bool)  # places without a piece of one character
        while len(starts) and len(self.keys):
            keys = nodes << _CODE_BITS | codes[starts + depth]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            there = self.keys[at] == keys
            starts, nodes = starts[there], self.children[at[there]]
            depth += 1
            ends = self.ids[nodes] >= 0
            found.append((starts[ends], starts[ends] + depth, self.ids[nodes[ends]], self.scores[nodes[ends]]))
            if depth == 1:
                alone[starts[ends]] = False
            more = starts + depth < behind[starts]
            starts, nodes = starts[more], nodes[more]
        rest = np.flatnonzero(alone)
        found.append((rest, rest + 1, np.full(len(rest), self.unk_id), np.full(len(rest), self.unknown)))
        return tuple(np.concatenate(x) for x in zip(*found))

    def _best(self, codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The id of the piece that starts at each place on the best paths, -1 within pieces. ``bounds``: where texts begin."""
        n = len(codes)
        first = np.zeros(n, dtype=bool)
        first[bounds] = True
        if self.by_word:
            first |= codes == 32
        begins = np.flatnonzero(first)
        begin = begins[np.cumsum(first) - 1]
        behind = np.r_[begins[1:], n][np.cumsum(first) - 1]
        start, end, ids, scores = self._edges(codes, behind)
        # By the place of the end in its stretch, then by end, the longest piece first.
        step = end - begin[start]
        order = np.lexsort((start, end, step))
        start, end, ids, scores, step = start[order], end[order], ids[order], scores[order], step[order]
        best, back = np.zeros(n), np.zeros(n, dtype=np.int64)  # of the path that ends with each place, and its last piece
        cuts = np.flatnonzero(np.r_[True, step[1:] != step[:-1]])
        for low, high in zip(cuts, [*cuts[1:], len(step)]):
            s, e = start[low:high], end[low:high]
            total = scores[low:high] + np.where(s > begin[s], best[np.maximum(s - 1, 0)], 0.0)
            groups = np.flatnonzero(np.r_[True, e[1:] != e[:-1]])
            most = np.maximum.reduceat(total, groups)
            of = np.repeat(np.arange(len(groups)), np.diff([*groups, len(e)]))
            hits = np.flatnonzero(total == most[of])
            chosen = hits[np.r_[True, of[hits][1:] != of[hits][:-1]]]
            best[e[chosen] - 1], back[e[chosen] - 1] = most, low + chosen
        out = np.full(n, -1, dtype=np.int64)
        at = np.r_[begins[1:], n] - 1
        while len(at):
            pieces = back[at]
            out[start[pieces]] = ids[pieces]
            at = start[pieces] - 1
            at = at[start[pieces] > begin[start[pieces]]]
        return out

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        out: list[list[int]] = [[] for _ in texts]
        of_part: list[int] = []
        done = 0
        for group in grouped(self._parts(texts, of_part), GROUP_CHARS):
            lengths = np.array([len(t) for t in group], dtype=np.int64)
            codes = np.frombuffer("".join(group).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
            ends = np.cumsum(lengths)
            found = self._best(codes, ends - lengths)
            for place, a, b in zip(of_part[done:], ends - lengths, ends):
                out[place] += found[a:b][found[a:b] >= 0].tolist()
            done += len(group)
        return out

    def _parts(self, texts: Sequence[str], of_part: list[int]) -> Iterator[str]:
        """The texts that are not empty, long ones cut before blanks if paths can be; the place of its text is put into ``of_part``."""
        for place, text in enumerate(texts):
            start = 0
            while start < len(text):
                end = len(text)
                if self.by_word and end - start > GROUP_CHARS:
                    last = text.rfind(" ", start + 1, start + GROUP_CHARS + 1)
                    behind = last if last > 0 else text.find(" ", start + GROUP_CHARS)
                    end = behind if behind > 0 else end
                of_part.append(place)
                yield text[start:end]
                start = end


def piece_map(pieces: DataFrame) -> dict[str, tuple[int, float]]:
    """{token: (id, score)} of a table (token, id, score); more than ``MAX_PIECES`` fail."""
    rows = pieces.select("token", "id", "score").limit(MAX_PIECES + 1).collect()
    if len(rows) > MAX_PIECES:
        raise ValueError(f"more than {MAX_PIECES} pieces")
    found = {r["token"]: (r["id"], float(r["score"])) for r in sorted(rows, key=lambda r: r["id"])}
    if len(found) < len(rows):
        raise ValueError("a piece is in the table twice")
    return found


def segment(
    df: DataFrame,
    pieces: DataFrame | Mapping[str, tuple[int, float]],
    text_col: str = "text",
    ids_col: str = "ids",
    *,
    count_col: str | None = None,
    unk_id: int = 0,
    max_tokens: int | None = None,
) -> DataFrame:
    """Add the ids of the best pieces of a text column in NFC; null stays null. Rows stay where they are: no shuffle."""
    known = dict(pieces) if isinstance(pieces, Mapping) else piece_map(pieces)

    def setup() -> Callable[[list[str]], list[list[int]]]:
        own = Segmenter(known, unk_id)
        return lambda texts: own.encode([unicodedata.normalize("NFC", t) for t in texts])

    return encode_with(df, setup=setup, text_col=text_col, ids_col=ids_col, count_col=count_col, max_tokens=max_tokens)
