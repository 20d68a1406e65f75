"""Words of many texts at once, as numpy arrays over the texts' UTF-8 bytes.

A word is a run of bytes outside space and 0x09-0x0D; these bytes never occur inside a multi-byte
character, so byte runs and code-point runs agree."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_GAP = np.zeros(256, dtype=bool)
_GAP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the base and of its inverse, grown as longer texts come."""

    def __init__(self) -> None:
        self.up = powers(_BASE, 0)
        self.down = self.up

    def grown(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(n, SLICE_BYTES)
            self.up, self.down = powers(_BASE, size), powers(_BASE_INVERSE, size)
        return self.up, self.down


@dataclass
class Words:
    """Words of a slice of texts. `data`: its bytes; word w is data[start[w]:end[w]]; document d owns
    words first[d]:first[d + 1]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    offsets: np.ndarray

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self, cache: _Powers, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of each word's bytes (A-Z folded if `lower`)."""
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        up, down = cache.grown(len(self.data))
        table = mix(np.arange(1, 257, dtype=np.uint64))
        if lower:
            table = table[_LOWER]
        sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
        np.cumsum(table[self.data] * up[: len(self.data)], out=sums[1:])
        own = (sums[self.end] - sums[self.start]) * down[self.start]
        return mix(own + (self.end - self.start).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def cache() -> _Powers:
    return _Powers()


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most about `size` bytes each; a longer text stands alone."""
    if not len(texts):
        return
    ends = np.cumsum(np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0)))
    low = 0
    while low < len(texts):
        floor = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, floor + size, side="right")))
        yield low, high
        low = high


def split(texts: pa.Array, gap: np.ndarray = _GAP) -> Words:
    """Words of an Arrow string array; NULL is a text without words. `gap`: which byte values end a word."""
    texts = pa.compute.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, where, buffer = texts.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    base, stop = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(buffer, dtype=np.uint8)[base:stop] if stop > base else np.zeros(0, np.uint8)
    offsets = offsets - base
    inside = ~gap[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cut = offsets[(offsets > 0) & (offsets < len(data))]
    begins[cut] = inside[cut]
    ends[cut - 1] = inside[cut - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(data, start, end, np.searchsorted(start, offsets), offsets)


def shingle_sets(words: Words, hashes: np.ndarray, n: int) -> list[np.ndarray]:
    """Per document the sorted distinct hashes of its n-word shingles; with fewer words the whole
    sequence is one shingle, without words the set is empty."""
    rolled = np.zeros(len(hashes), dtype=np.uint64)
    for k in range(n):
        part = hashes[k:]
        rolled[: len(part)] = mix(rolled[: len(part)] * _U(_BASE) + part + _U(k + 1))
    sets = []
    for low, high in zip(words.first[:-1], words.first[1:]):
        count = high - low
        if count >= n:
            sets.append(np.unique(rolled[low : high - n + 1]))
        elif count:
            whole = np.array([count], dtype=np.uint64)
            for h in hashes[low:high]:
                whole = mix(whole * _U(_BASE) + h)
            sets.append(whole)
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets
