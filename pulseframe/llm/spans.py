"""Words of many texts at once, where each operator says which bytes lie between words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pulseframe.llm.rolling import BYTE_VALUES, LOWER, Texts, Windows


def byte_set(*values: int | range) -> np.ndarray:
    """A table of 256 marks, set for the given bytes."""
    marks = np.zeros(256, dtype=bool)
    for v in values:
        marks[np.array(v) if isinstance(v, int) else np.array(list(v))] = True
    return marks


class Spans:
    """Maximal runs of bytes outside `gaps`: byte ranges, hashes, and the range of runs of each text.

    Only A-Z are folded, if `lower`. Runs never cross texts.
    """

    def __init__(self, texts: Texts, gaps: np.ndarray, lower: bool = False):
        self.texts = texts
        self.data = LOWER[texts.data] if lower else texts.data
        between = gaps[self.data]
        first = np.zeros(len(self.data) + 1, dtype=bool)
        first[texts.bounds] = True
        starts = ~between
        starts[1:] &= between[:-1] | first[1:-1]
        ends = ~between
        ends[:-1] &= between[1:] | first[1:-1]
        self.start = np.flatnonzero(starts)
        self.end = np.flatnonzero(ends) + 1
        self.bounds = np.searchsorted(self.start, texts.bounds)
        self.count = np.diff(self.bounds)

    def hashes(self) -> np.ndarray:
        return Windows(BYTE_VALUES[self.data]).of(self.start, self.end)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    def words(self, chosen: np.ndarray) -> pa.Array:
        """The chosen runs as strings."""
        size = self.end[chosen] - self.start[chosen]
        ends = np.cumsum(size)
        place = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - size, size) + np.repeat(self.start[chosen], size)
        offsets = np.concatenate([[0], ends]).astype(np.int64)
        made = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(chosen), [None, pa.py_buffer(offsets), pa.py_buffer(self.data[place].tobytes())])
        return made.cast(pa.large_string()).cast(pa.string())


def slices(table: pa.Table | pa.RecordBatch, text: str, most: int) -> Iterator[pa.Table]:
    """Consecutive rows with about `most` bytes of text together; a longer text comes alone."""
    table = pa.Table.from_batches([table]) if isinstance(table, pa.RecordBatch) else table
    sizes = np.nan_to_num(pc.binary_length(table.column(text)).to_numpy(zero_copy_only=False).astype(float))
    at, held = 0, 0.0
    for i, size in enumerate(sizes):
        if i > at and held + size > most:
            yield table.slice(at, i - at)
            at, held = i, 0.0
        held += size
    if at < len(sizes):
        yield table.slice(at)
