"""Hashes of the words of a text and of its word shingles, a whole text at a time in numpy."""

from __future__ import annotations

import re

import numpy as np
import xxhash

SPACE = re.compile(rb"[\x20\x09-\x0D]")
PIECE = 1 << 16
SHINGLE = 5


def _constants():
    rng = np.random.Generator(np.random.PCG64(20240917))
    table = rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
    space = np.zeros(256, dtype=bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    table[space] = 0
    table[65:91] = table[97:123]  # A-Z as a-z
    base = 0x9E3779B97F4A7C15 | 1
    inverse = pow(base, -1, 2**64)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.r_[np.uint64(1), np.full(PIECE, base, dtype=np.uint64)])
        inverses = np.cumprod(np.r_[np.uint64(1), np.full(PIECE, inverse, dtype=np.uint64)])
    return table, space, powers, inverses


TABLE, IS_SPACE, POWERS, INVERSES = _constants()
PLACES = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _piece(codes: np.ndarray) -> np.ndarray:
    word = ~IS_SPACE[codes]
    edge = np.diff(word.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(TABLE[codes] * POWERS[: len(codes)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * INVERSES[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 text, A-Z taken as a-z.

    Works through the text in pieces, so its memory is the result plus a bounded piece. Words that
    don't fit into a piece are hashed by xxhash. Empty text: no words.
    """
    codes = np.frombuffer(data, dtype=np.uint8)
    out, at, n = [], 0, len(data)
    while at < n:
        end = min(n, at + PIECE)
        if end < n or end - at == PIECE:
            spaces = np.flatnonzero(IS_SPACE[codes[at:end]])
            if len(spaces) == 0:
                found = SPACE.search(data, end)
                end = found.start() if found else n
                out.append(np.array([xxhash.xxh64_intdigest(data[at:end].lower())], dtype=np.uint64))
                at = end
                continue
            end = at + int(spaces[-1]) + 1
        out.append(_piece(codes[at:end]))
        at = end
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def shingle_set(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of runs of ``size`` words; fewer words make one run, none an empty set."""
    n = len(words)
    if n == 0:
        return words
    width = min(size, n)
    runs = np.full(n - width + 1, width, dtype=np.uint64)
    for k in range(width):
        runs += words[k : n - width + 1 + k] * PLACES[k % len(PLACES)]
        runs = mix(runs) if k % 2 else runs
    return np.unique(mix(runs))
