"""FM-index over a sequence of small integers: suffix array, wavelet matrix, backward search, sampled positions."""

from __future__ import annotations

import numpy as np

SAMPLE = 16


def suffix_array(symbols: np.ndarray, bits: int) -> np.ndarray:
    """Order of all suffixes by prefix doubling; only groups still tied are sorted again.

    symbols are at least 1 and below 2**bits; the end of the sequence sorts first.
    """
    n = len(symbols)
    packed = max(1, 62 // bits)
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(packed, np.int64)])
    key = np.zeros(n, np.int64)
    for j in range(packed):
        key = key << bits | padded[j : j + n]
    order = np.argsort(key, kind="stable")
    key = key[order]
    head = np.concatenate([[True], key[1:] != key[:-1]]) if n else np.zeros(0, bool)
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1  # past the end
    group = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank[order] = group
    tied = np.flatnonzero(~(head & np.concatenate([head[1:], [True]]))) if n else np.zeros(0, np.int64)
    depth = packed
    while len(tied):
        at = order[tied]
        key = rank[at] * (n + 2) + rank[np.minimum(at + depth, n)] + 1
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[tied] = at
        head = np.concatenate([[True], key[1:] != key[:-1]])
        lead = np.maximum.accumulate(np.where(head, np.arange(len(tied)), 0))
        rank[at] = tied[lead]
        tied = tied[~(head & np.concatenate([head[1:], [True]]))]
        depth *= 2
    return order


class Wavelet:
    """Wavelet matrix: rank of a symbol, and symbol with rank, in one step per bit."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        x = symbols
        for level in range(bits - 1, -1, -1):
            one = (x >> level & 1).astype(bool)
            ones = np.concatenate([np.zeros(1, np.int32), np.cumsum(one, dtype=np.int32)])
            x = np.concatenate([x[~one], x[one]])
            self.levels.append((level, ones, len(x) - int(ones[-1])))

    def down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Place of (symbol, i) in the last level; differences of places are ranks."""
        for level, ones, zeros in self.levels:
            r = ones[i]
            i = np.where(symbol >> level & 1, zeros + r, i - r)
        return i

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol at i, its place in the last level)."""
        symbol = np.zeros(len(i), np.int64)
        for level, ones, zeros in self.levels:
            r = ones[i]
            one = ones[i + 1] != r
            symbol |= one.astype(np.int64) << level
            i = np.where(one, zeros + r, i - r)
        return symbol, i


class FMIndex:
    """symbols: integers from 1 on; alphabet: one more than the largest there may be."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        bits = max(1, int(alphabet - 1).bit_length())
        text = np.concatenate([symbols.astype(np.int64), [0]])  # 0 ends it
        order = np.concatenate([[len(symbols)], suffix_array(symbols, bits)])
        last = text[order - 1]  # the symbol before each suffix
        self.wavelet = Wavelet(last, bits)
        self.below = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=alphabet))])[:alphabet]
        self.base = self.wavelet.down(np.arange(alphabet), np.zeros(alphabet, np.int64))
        self.marked = order % SAMPLE == 0
        self.sampled = order[self.marked]
        self.before = np.cumsum(self.marked) - self.marked
        self.size = len(text)

    def _map(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        return self.below[symbol] + place - self.base[symbol]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [lo, hi) of suffixes that begin with each pattern; patterns are right-aligned."""
        lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size, np.int64)
        width = patterns.shape[1]
        live = np.arange(len(patterns))
        for back in range(1, width + 1):
            live = live[(lengths[live] >= back) & (lo[live] < hi[live])]
            if not len(live):
                break
            c = patterns[live, width - back]
            lo[live] = self._map(c, self.wavelet.down(c, lo[live]))
            hi[live] = self._map(c, self.wavelet.down(c, hi[live]))
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Start of the suffix of each row: walk back to a sampled one."""
        out, steps = np.zeros(len(rows), np.int64), 0
        live, at = np.arange(len(rows)), rows.copy()
        while len(live):
            known = self.marked[at]
            out[live[known]] = self.sampled[self.before[at[known]]] + steps
            live, at = live[~known], at[~known]
            symbol, place = self.wavelet.access(at)
            at = self._map(symbol, place)
            steps += 1
        return out
