"""Words of Arrow text columns as numpy arrays, for the tasks of the operators here.

``scan`` finds every word of a slice of texts at once and gives each a 64-bit
hash that depends on its bytes alone; ``Rolling`` hashes any run of consecutive
words in constant time: polynomials modulo two primes, 64 bits together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_MULT = 0x9E3779B97F4A7C15

# Bytes of texts that are held as numpy arrays at once (a longer single text is held alone).
SLICE_BYTES = 1 << 20


def _splitmix(n: int, seed: int) -> np.ndarray:
    """n well mixed 64-bit values, the same on every machine."""
    with np.errstate(over="ignore"):
        z = (np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) * np.uint64(_MULT)
        return mix(z)


def mix(z: np.ndarray) -> np.ndarray:
    """Finalising bit mixer (a bijection on 64 bits)."""
    with np.errstate(over="ignore"):
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def byte_table(separators: bytes, lower: bool) -> np.ndarray:
    """256 entries: the byte a byte stands for in a word; 0 for a separator."""
    t = np.arange(256, dtype=np.uint8)
    if lower:
        t[65:91] += 32
    t[np.frombuffer(separators, np.uint8)] = 0
    return t


WHITE = bytes([32, 9, 10, 11, 12, 13])
# Everything of ASCII but letters and digits.
PUNCTUATION = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


def text_slices(col: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) over a string column; null reads as empty."""
    if col.null_count:
        col = col.fill_null("")
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    wide = pa.types.is_large_string(col.type)
    off = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64) if len(col) else np.zeros(1, np.int64)
    data = col.buffers()[2] if len(col) else None
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(col):
        end = max(row + 1, int(np.searchsorted(off, off[row] + most, side="right")) - 1)
        yield row, raw[off[row] : off[end]], off[row : end + 1] - off[row]
        row = end


# The largest primes below 2**32. Polynomials modulo a power of two are no hashes: there,
# unequal Thue-Morse words meet whatever the base is.
PRIMES = (4294967291, 4294967279)


class Powers:
    """Powers of a number and of its inverse modulo each of PRIMES, grown on demand."""

    def __init__(self, base: int):
        self.bases = [(base >> 32) % PRIMES[0] or 3, base % PRIMES[1] or 5]
        self.up = [np.ones(1, np.uint64) for _ in PRIMES]
        self.down = [np.ones(1, np.uint64) for _ in PRIMES]

    def upto(self, n: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
        for i, p in enumerate(PRIMES):
            inverse = pow(self.bases[i], -1, p)
            while len(self.up[i]) < n:
                k = len(self.up[i])
                for powers, base in ((self.up, self.bases[i]), (self.down, inverse)):
                    powers[i] = np.concatenate([powers[i], powers[i] * np.uint64(pow(base, k, p)) % np.uint64(p)])
        return self.up, self.down


def reduced(values: np.ndarray) -> list[np.ndarray]:
    """64-bit values modulo each of PRIMES."""
    return [values % np.uint64(p) for p in PRIMES]


class Rolling:
    """Hashes of runs values[start:start+length] of 64-bit values, given modulo each of PRIMES (fewer than 2**32 of them)."""

    def __init__(self, values: list[np.ndarray], powers: Powers):
        up, self.down = powers.upto(len(values[0]) + 1)
        self.sums = []
        for v, u, p in zip(values, up, PRIMES, strict=True):
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(v * u[: len(v)] % np.uint64(p), dtype=np.uint64)]))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        high, low = ((s[end] - s[start]) % np.uint64(p) * d[start] % np.uint64(p) for s, d, p in zip(self.sums, self.down, PRIMES, strict=True))
        return mix(high << np.uint64(32) | low)


class Scanner:
    """Finds and hashes words; make one per task."""

    def __init__(self, table: np.ndarray):
        self.table = table
        values = _splitmix(256, 77)
        values[0] = 0
        self.values = reduced(values)
        self.powers = Powers(0xD1342543DE82EF95)

    def scan(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(word hash, byte start, byte end, first word of each text plus the total)."""
        b = self.table[raw]
        inside = b != 0
        edge = offsets[offsets < len(raw)]
        before = np.empty(len(raw), bool)
        if len(raw):
            before[0] = False
            before[1:] = inside[:-1]
            before[edge] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.zeros(len(raw), bool)
        if len(raw):
            after[:-1] = inside[1:]
            after[edge[edge > 0] - 1] = False
        ends = np.flatnonzero(inside & ~after) + 1
        h = Rolling([v[b] for v in self.values], self.powers).of(starts, ends)
        return h, starts, ends, np.searchsorted(starts, offsets)


def texts_of(col: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text; null reads as empty."""
    for _, raw, off in text_slices(col):
        data = raw.tobytes()
        for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
            yield data[a:b]
