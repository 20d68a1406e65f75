"""A compressed FM-index over the word sequences of one shard, in numpy.

The text's symbols are sorted by their first `depth` successors (longer order is never asked for). The BWT
is kept as a wavelet matrix of packed bits with rank counts. Marks say which neighbouring rows of the
sorted order share `depth` and `depth - 1` symbols; the latter give the parent interval that a matching
statistic of length `depth` falls back to before the next symbol is prepended."""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BELOW = (_U(1) << np.arange(64, dtype=np.uint64)) - _U(1)


class Wavelet:
    """Wavelet matrix: maps a position and a symbol to the number of that symbol before the position."""

    def __init__(self, symbols: np.ndarray, top: int) -> None:
        self.levels = max(1, int(top).bit_length())
        self.size = len(symbols)
        self.words, self.counts, self.zeros = [], [], []
        for level in reversed(range(self.levels)):
            bits = (symbols >> level) & 1
            packed = np.packbits(bits.astype(np.uint8), bitorder="little")
            packed = np.concatenate([packed, np.zeros(16 - len(packed) % 8, dtype=np.uint8)]).view(np.uint64)
            self.words.append(packed)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int32)])[:-1])
            order = bits == 0
            self.zeros.append(int(order.sum()))
            symbols = np.concatenate([symbols[order], symbols[~order]])

    def follow(self, at: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Where positions end up below all levels on their symbols' paths."""
        at = at.astype(np.int32)
        for depth, (words, counts, zeros) in enumerate(zip(self.words, self.counts, self.zeros)):
            word = at >> 6
            mask = _BELOW.take(at & 63)
            ones = counts.take(word)
            ones += np.bitwise_count(words.take(word) & mask)
            one = (symbols >> (self.levels - 1 - depth)) & 1 == 1
            at = np.where(one, zeros + ones, at - ones).astype(np.int32, copy=False)
        return at.astype(np.int64)


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys and each key's dense rank."""
    order = np.argsort(keys, kind="stable")
    new = np.empty(len(keys), dtype=np.int64)
    new[:1] = 0
    new[1:] = np.cumsum(keys[order][1:] != keys[order][:-1])
    rank = np.empty(len(keys), dtype=np.int64)
    rank[order] = new
    return order, rank


class FMIndex:
    """`symbols`: non-negative integers; 0 only where a sequence ends. depth is a pattern's length."""

    def __init__(self, symbols: np.ndarray, depth: int) -> None:
        self.depth, n = depth, len(symbols)
        symbols = symbols.astype(np.int64)
        by_length = {1: symbols}

        def joined(a: int, b: int) -> np.ndarray:
            """Keys of the first a + b symbols, from ranks by a and by b symbols."""
            after = np.zeros(n, dtype=np.int64)
            after[: n - a] = by_length[b][a:]
            return by_length[a] * (int(by_length[b].max(initial=0)) + 1) + after

        length = 1
        while 2 * length <= depth:
            by_length[2 * length] = _ranks(joined(length, length))[1]
            length *= 2
        parts, rest = [length], depth - length
        for size in sorted(by_length, reverse=True):
            while size <= rest:
                parts.append(size)
                rest -= size
        done = parts[0]
        for part in parts[1:]:
            by_length[done + part] = _ranks(joined(done, part))[1]
            done += part
        self.order, rank = _ranks(by_length[depth])
        self.group = rank[self.order]  # rows that share `depth` symbols
        below = self._shared(by_length, depth - 1)
        self.parent = np.concatenate([[0], np.cumsum(~below)]) if n else np.zeros(0, dtype=np.int64)
        starts = np.flatnonzero(np.concatenate([[True], ~below])) if n else np.zeros(0, dtype=np.int64)
        self.bounds = np.append(starts, n)  # rows that share depth - 1 symbols: their intervals
        top = int(symbols.max(initial=0))
        bwt = symbols[self.order - 1]
        self.wavelet = Wavelet(bwt, top)
        count = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=top + 1))])
        every = np.arange(top + 1)
        self.base = count[:-1] - self.wavelet.follow(np.zeros(top + 1, dtype=np.int64), every)
        self.size = n

    def _shared(self, by_length: dict[int, np.ndarray], length: int) -> np.ndarray:
        """Whether each row and the next share `length` symbols."""
        a, b = self.order[:-1], self.order[1:]
        same = np.ones(len(a), dtype=bool)
        at = 0
        for size in sorted((s for s in by_length if s & (s - 1) == 0), reverse=True):
            while size <= length - at:
                x, y = np.minimum(a + at, len(self.order) - 1), np.minimum(b + at, len(self.order) - 1)
                same &= by_length[size][x] == by_length[size][y]
                at += size
        return same

    def back(self, low: np.ndarray, high: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals after one symbol is prepended: one step of backward search."""
        both = self.wavelet.follow(np.concatenate([low, high]), np.concatenate([symbols, symbols]))
        base = self.base[symbols]
        return base + both[: len(low)], base + both[len(low) :]

    def matches(self, symbols: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """For sequences symbols[start:end], streamed from right to left: at each position the first row
        of the interval of the next `depth` symbols, or -1 where their matching statistic is shorter.

        All sequences advance together. A match of full depth falls back to its parent interval before the
        next symbol; a match that breaks drops its last symbol and is built again."""
        found = np.full(len(symbols), -1, dtype=np.int64)
        lane = np.flatnonzero(end - start >= self.depth)
        first, last = start[lane], end[lane].copy()
        at = last.copy()
        low, high = np.zeros(len(lane), dtype=np.int64), np.full(len(lane), self.size, dtype=np.int64)
        while len(first):
            at = at - 1
            low, high = self.back(low, high, symbols[at])
            broken = low >= high
            full = ~broken & (last - at == self.depth)
            found[at[full]] = low[full]
            parent = self.parent[np.where(full, low, 0)] if self.size else low
            low = np.where(full, self.bounds[parent], low)
            high = np.where(full, self.bounds[parent + 1], high)
            last = last - (full | broken)
            at = np.where(broken, last, at)
            low, high = np.where(broken, 0, low), np.where(broken, self.size, high)
            go = last - first >= self.depth
            if not go.all():
                first, last, at, low, high = first[go], last[go], at[go], low[go], high[go]
        return found
