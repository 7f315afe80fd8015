"""Words and window hashes of many texts at once, in numpy.

Texts lie one after another in one byte array. A window's hash is a polynomial
modulo 2**64 taken from prefix sums, so that all windows cost a few array operations.
The odd base has an inverse, which makes equal windows equal wherever they start.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)
OTHER_BASE = np.uint64(0xD6E8FEB86659FD93)

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i < n, at least."""
    known = _powers.get(int(base))
    if known is None or len(known[0]) < n:
        size = -(-n // (1 << 18)) << 18
        both = []
        for b in (int(base), pow(int(base), -1, 1 << 64)):
            row = np.full(size, b, dtype=np.uint64)
            row[0] = 1
            both.append(np.multiply.accumulate(row))
        known = _powers[int(base)] = (both[0], both[1])
    return known


class Windows:
    """Hashes of windows [start, end) of a row of 64-bit values."""

    def __init__(self, values: np.ndarray, base: np.uint64 = BASE):
        up, self.down = powers(base, len(values) + 1)
        self.sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def sliding(self, length: int) -> np.ndarray:
        """Of every window of that length; may run over the ends of texts."""
        n = len(self.sums) - length
        if n <= 0:
            return np.empty(0, dtype=np.uint64)
        return mix((self.sums[length:] - self.sums[:-length]) * self.down[:n])


class Texts:
    """The UTF-8 bytes of a column of texts; a null is an empty text."""

    def __init__(self, column: pa.ChunkedArray | pa.Array):
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays([c.cast(pa.large_binary()) for c in column.chunks] or [pa.array([], pa.large_binary())])
        else:
            column = column.cast(pa.large_binary())
        self.n = len(column)
        if self.n == 0:
            self.data, self.bounds = np.empty(0, np.uint8), np.zeros(1, np.int64)
            return
        _, offsets, data = column.buffers()
        ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + self.n + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
        if column.null_count:
            # A null may leave bytes behind: take the others only.
            sizes = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(ends), 0)
            self.data = np.concatenate([raw[a : a + s] for a, s in zip(ends[:-1], sizes)] or [raw[:0]])
            self.bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        else:
            self.data = raw[ends[0] : ends[-1]]
            self.bounds = ends - ends[0]

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.bounds[i] : self.bounds[i + 1]].tobytes()


#: Bytes between words: space and the controls from tab to carriage return.
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words:
    """Words of the texts: byte ranges, hashes, and the range of words of each text."""

    def __init__(self, texts: Texts, lower: bool = False):
        data = LOWER[texts.data] if lower else texts.data
        inside = np.zeros(len(data) + 2, dtype=bool)
        inside[1:-1] = ~WHITE[data]
        starts_word = inside[1:-1] & ~inside[:-2]
        ends_word = inside[1:-1] & ~inside[2:]
        # A text's first byte starts a word and its last byte ends one, whatever the neighbour holds.
        filled = np.flatnonzero(np.diff(texts.bounds) > 0)
        first, last = texts.bounds[filled], texts.bounds[filled + 1] - 1
        starts_word[first] = inside[1:-1][first]
        ends_word[last] = inside[1:-1][last]
        self.start = np.flatnonzero(starts_word)
        self.end = np.flatnonzero(ends_word) + 1
        self.hashes = Windows(BYTE_VALUES[data]).of(self.start, self.end)
        self.bounds = np.searchsorted(self.start, texts.bounds)
        self.count = np.diff(self.bounds)
        self.texts = texts


def positions(bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows of that length inside the ranges, and the range of each."""
    sizes = np.maximum(np.diff(bounds) - length + 1, 0)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else np.empty(0, np.int64)
    start = np.arange(len(owner)) - first[owner] + bounds[owner] if len(owner) else np.empty(0, np.int64)
    return start.astype(np.int64), owner.astype(np.int64)


def covered(starts: np.ndarray, lengths, size: int) -> np.ndarray:
    """Which of `size` places lie in any of the ranges."""
    steps = np.zeros(size + 1, dtype=np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + lengths, -1)
    return np.cumsum(steps[:-1]) > 0
