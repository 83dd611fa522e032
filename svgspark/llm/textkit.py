"""Array forms of the text primitives: words, hashes of byte spans, distinct shingles.

They run inside Arrow tasks on the UTF-8 buffers of a column, a segment of documents at a time, so a
task's memory is bounded by ``SEGMENT`` bytes (or its longest single text) times a small factor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEGMENT = 1 << 19
U64 = np.uint64

_sep = np.zeros(256, dtype=bool)
_sep[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
IN_WORD = ~_sep


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or large binary column; null strings count as empty."""
    arr = column if pa.types.is_large_binary(column.type) else pc.fill_null(column, "").cast(pa.large_string())
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, np.int64)[arr.offset:arr.offset + len(arr) + 1] if len(arr) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def segments(offsets: np.ndarray, most: int = SEGMENT) -> Iterator[tuple[int, int]]:
    """Ranges of documents of at most ``most`` bytes together, or of one longer document."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit words (xor-shift and multiply)."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


class SpanHash:
    """Hash of any byte span from one prefix sum: sum of T[byte] * P^i modulo 2^64, moved back to i = 0."""

    P = 0x9E3779B97F4A7C13  # 3 modulo 8: the powers repeat as late as they can

    def __init__(self, seed: int = 11, fold: bool = False) -> None:
        self.table = np.random.default_rng(seed).integers(1, 2**64, 256, dtype=np.uint64)
        if fold:
            self.table[65:91] = self.table[97:123]
        self.power = self.inverse = np.ones(1, U64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n + 1:
            size = max(n + 1, SEGMENT + 1)
            step = np.full(size, self.P, U64)
            step[0] = 1
            back = np.full(size, pow(self.P, -1, 2**64), U64)
            back[0] = 1
            self.power, self.inverse = np.cumprod(step), np.cumprod(back)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        self._grow(n)
        out = np.zeros(n + 1, U64)
        np.cumsum(self.table[data] * self.power[:n], out=out[1:])
        return out

    def spans(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (prefix[ends] - prefix[starts]) * self.inverse[starts]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first run of each document) of the maximal runs of True; runs end at document ends."""
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = offsets[(offsets > 0) & (offsets < len(inside))]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each document) of the runs of ``[^\\x20\\x09-\\x0D]``."""
    return runs(IN_WORD[data], offsets)


def followed(x: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Hash of each run of words with the next word."""
    return mix(mix(x) * U64(0x9FB21C651E98DF25) + h)


def shingles(h: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct shingles of ``width`` words of one document's word hashes; fewer words are one shingle."""
    if len(h) >= width:
        n = len(h) - width + 1
        x = h[:n]
        for k in range(1, width):
            x = followed(x, h[k:k + n])
        return np.unique(x)
    x = mix(h[:1] ^ U64(0x5851F42D4C957F2D))
    for k in range(1, len(h)):
        x = followed(x, h[k:k + 1])
    return x
