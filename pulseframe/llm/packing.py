"""Packing of tokenised documents into training sequences by bounded-space online best-fit.

Each task places pieces as they come, those of about a megabyte of text by falling length. It has a fixed number of open sequences, found by their
free space in a bitset: the fitting one with the least room takes the piece, and when all are taken
and none fits, the fullest closes. What is open at a task's end is packed once more, whole, among
the open sequences of neighbouring tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.llm.token_ids import encoder
from pulseframe.staging import stage

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, open boolean"
MERGED = "sequence_id long, target long, shift long"

#: Texts tokenised at a time, in characters.
BATCH_CHARS = 1 << 20
#: Tasks whose open sequences are packed together.
TASKS_TOGETHER = 32
#: Pieces of closed sequences that are handed on at a time.
ROWS_AT_ONCE = 10_000


class OpenSequences:
    """At most `most` open sequences; a bit for each free space that one of them has."""

    def __init__(self, size: int, most: int):
        self.size, self.most, self.count = size, most, 0
        self.bits = 0
        self.by_free: dict[int, list[int]] = {}
        self.next_name = 0
        #: Sequences that no piece can join any more, until the caller clears the list.
        self.closed: list[int] = []

    def _take(self, free: int) -> int:
        names = self.by_free[free]
        name = names.pop()
        if not names:
            del self.by_free[free]
            self.bits ^= 1 << free
        self.count -= 1
        return name

    def _put(self, name: int, free: int) -> None:
        self.by_free.setdefault(free, []).append(name)
        self.bits |= 1 << free
        self.count += 1

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) for a piece."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            name = self._take(free)
        else:
            if self.count == self.most:
                self.closed.append(self._take((self.bits & -self.bits).bit_length() - 1))
            free, name = self.size, self.next_name
            self.next_name += 1
        if free > length:
            self._put(name, free - length)
        else:
            self.closed.append(name)
        return name, self.size - free

    def open_names(self) -> set[int]:
        return {name for names in self.by_free.values() for name in names}


def cuts(length: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all of `size` but the first, which has the rest."""
    first = length if length <= size else length % size or size
    return [(0, first)] + [(at, size) for at in range(first, length, size)]


def _tokenised(parts: Iterator[pa.RecordBatch], path: str | None, end_id: int) -> Iterator[list[tuple[int | None, bytes]]]:
    encode = encoder(path)
    end = end_id.to_bytes(4, "little")
    for part in parts:
        names, texts = part.column("doc_id"), part.column("text")
        at = 0
        while at < len(part):
            chars, stop, batch = 0, at, []
            while stop < len(part) and (not batch or chars < BATCH_CHARS):
                text = texts[stop].as_py() or ""
                batch.append(text)
                chars += len(text)
                stop += 1
            yield [(names[at + i].as_py(), ids + end) for i, ids in enumerate(encode.batch(batch))]
            at = stop


def _pack(parts: Iterator[pa.RecordBatch], path: str | None, size: int, end_id: int, most_open: int) -> Iterator[pa.RecordBatch]:
    base = TaskContext.get().partitionId() << 33
    bins = OpenSequences(size, most_open)
    # Pieces wait for their sequence to close, so that no more of them are held than open sequences have.
    waiting: dict[int, list[tuple]] = {}
    rows: list[tuple] = []
    for batch in _tokenised(parts, path, end_id):
        pieces = []
        for name, ids in batch:
            for piece, (start, length) in enumerate(cuts(len(ids) // 4, size)):
                pieces.append((name, piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
        # Of the pieces at hand the longest come first: they fit in the fewest places.
        for row in sorted(pieces, key=lambda p: -p[3]):
            placed = bins.place(row[3])
            waiting.setdefault(placed[0], []).append((*row, *placed))
            for sequence in bins.closed:
                rows += waiting.pop(sequence)
            bins.closed.clear()
            if len(rows) >= ROWS_AT_ONCE:
                yield _piece_rows(rows, base, False)
                rows = []
    yield _piece_rows(rows, base, False)
    yield _piece_rows([row for held in waiting.values() for row in held], base, True)


def _piece_rows(rows: list[tuple], base: int, is_open: bool) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 7
    arrays = [
        pa.array(columns[0], pa.int64()),
        pa.array(columns[1], pa.int32()),
        *(pa.array(c, pa.int64()) for c in columns[2:5]),
        pa.array([base + s for s in columns[5]], pa.int64()),
        pa.array(columns[6], pa.int64()),
        pa.array([is_open] * len(rows), pa.bool_()),
    ]
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "open"]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    size: int = 1024,
    end_id: int = 2,
    most_open: int = 256,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: where every piece lies.

    A document is its token ids and `end_id`; one of more than `size` ids is cut from its end into
    pieces of `size`, so that only the first may be shorter. Sequences hold `size` ids at most
    and are filled without gaps from offset 0. `tokenizer` is a file that all machines have; by
    default that of the public byte-level BPE.

    A null text is empty and consists of `end_id`. Every row is packed, rows without an id and rows
    that share one too. Other columns are ignored. A task holds the pieces of its open sequences and about a
    megabyte of text, or one text if that is longer. Which documents meet in a sequence depends on
    how the input is partitioned; lengths, pieces and ids do not.
    """
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    packed = stage(source.mapInArrow(lambda parts: _pack(parts, tokenizer, size, end_id, most_open), PIECES), "packed")
    left = packed.where("open").groupBy("sequence_id").agg(F.sum("length").alias("used"))
    left = left.withColumn("together", F.shiftright(F.shiftright("sequence_id", 33), TASKS_TOGETHER.bit_length() - 1))

    def merge(table: pa.Table) -> pa.Table:
        # The largest first, then the smallest id: the same answer in whatever order the rows come.
        rows = sorted(table.select(["sequence_id", "used"]).to_pylist(), key=lambda r: (-r["used"], r["sequence_id"]))
        bins, targets, out = OpenSequences(size, len(rows)), {}, []
        for r in rows:
            name, shift = bins.place(r["used"])
            out.append((r["sequence_id"], targets.setdefault(name, r["sequence_id"]), shift))
        columns = zip(("sequence_id", "target", "shift"), zip(*out))
        return pa.table({name: pa.array(values, pa.int64()) for name, values in columns})

    moved = left.groupBy("together").applyInArrow(merge, MERGED)
    return packed.join(moved, "sequence_id", "left").select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        F.coalesce("target", "sequence_id").alias("sequence_id"),
        (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
    )
