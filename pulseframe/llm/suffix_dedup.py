"""Removal of byte strings that repeat across documents, by a depth-limited radix sort of suffixes.

Suffixes are ordered by their first `window` bytes only, most significant digit first, and a
group that cannot hold a repeat is not sorted further:

1. The leading digit is the first `digit` bytes at a suffix that every equal window meets at the
   same place: the least hash among the starts inside the window. Neighbouring windows that meet
   the same one form a run and move as one. A digit held by one document alone is finished.
2. Runs of a group are ordered by their whole stretch of bytes. A run that equals one of an
   earlier document is decided; a group whose runs are all equal is finished.
3. What is left, the edges of repeats, is ordered suffix by suffix to the full depth.

Equal groups at full depth are exactly the repeated windows. Digits are compared by hashes; each
bucket takes those with equal leading bits and sorts them in memory.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pulseframe.llm import exchange
from pulseframe.llm.rolling import BYTE_VALUES, OTHER_BASE, Texts, Windows, covered, mix

RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"

#: Texts are searched for runs so many bytes at a time; a longer text is one block.
BLOCK_BYTES = 1 << 17


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` neighbours, by doubling."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    if width > span:
        rest = width - span
        values = np.minimum(values[:-rest], values[rest:])
    return values


class _Runs:
    """Runs of a chunk: the leading suffix, first and last window start, and document of each."""

    def __init__(self, table: pa.Table, window: int, digit: int, bits: int):
        self.window = window
        self.rows = exchange.in_order(table)
        self.ids = exchange.column(self.rows, "doc_id")
        self.chunk = int(self.rows.column("chunk")[0].as_py())
        self.texts = Texts(self.rows.column("text"))
        bounds = self.texts.bounds
        self.values = BYTE_VALUES[self.texts.data]
        self.hashes = Windows(self.values)
        lead, first, last, owner = [], [], [], []
        block = 0
        while block < self.texts.n:
            stop = max(block + 1, int(np.searchsorted(bounds, bounds[block] + BLOCK_BYTES, "right")) - 1)
            lo, hi = int(bounds[block]), int(bounds[stop])
            found = self._runs_of(lo, hi, bounds[block : stop + 1] - lo, digit)
            if found is not None:
                lead.append(found[0] + lo)
                first.append(found[1] + lo)
                last.append(found[2] + lo)
                owner.append(found[3] + block)
            block = stop
        whole = lambda parts: np.concatenate(parts) if parts else np.empty(0, np.int64)
        self.lead, self.first, self.last, self.owner = whole(lead), whole(first), whole(last), whole(owner)
        self.digits = self.hashes.of(self.lead, self.lead + digit)
        self.keys, self.place, _ = exchange.distinct(self.digits, bits)
        low = np.full(len(self.keys), self.texts.n, np.int64)
        high = np.full(len(self.keys), -1, np.int64)
        np.minimum.at(low, self.place, self.owner)
        np.maximum.at(high, self.place, self.owner)
        self.holders = np.where(low == high, 1, 2)

    def _runs_of(self, lo: int, hi: int, bounds: np.ndarray, digit: int):
        n = hi - lo - self.window + 1
        if n <= 0:
            return None
        sums, down = self.hashes.sums[lo : hi + 1], self.hashes.down[lo:hi]
        m = hi - lo - digit + 1
        ranks = (sums[digit:] - sums[:-digit]) * down[:m]
        ranks *= np.uint64(0x9FB21C651E98DF25)
        # The hash decides and, among equal ones, the first place.
        ranks = (ranks & np.uint64(0xFFFFFFFF00000000)) | np.arange(m, dtype=np.uint64)
        least = _sliding_least(ranks, self.window - digit + 1)
        at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        sizes = np.diff(bounds)
        inside = np.zeros(hi - lo + 1, np.int8)
        long = sizes >= self.window
        inside[bounds[:-1][long]] += 1
        inside[bounds[1:][long] - self.window + 1] -= 1
        valid = np.cumsum(inside[:n]) > 0
        start = np.flatnonzero(valid)
        if not len(start):
            return None
        at = at[start]
        fresh = np.concatenate([[True], (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)])
        heads = np.flatnonzero(fresh)
        tails = np.concatenate([heads[1:] - 1, [len(start) - 1]])
        first = start[heads]
        return at[heads], first, start[tails], np.searchsorted(bounds, first, "right") - 1

    def live(self, levels: np.ndarray) -> np.ndarray:
        """Runs whose leading digit two documents hold."""
        return np.flatnonzero((levels >= 2)[self.place]) if len(levels) else np.empty(0, np.int64)

    def stretches(self, runs: np.ndarray, bits: int) -> exchange.Claims:
        start, end = self.first[runs], self.last[runs] + self.window
        shape = (self.lead[runs] - start).astype(np.uint64) << np.uint64(32) | (end - start).astype(np.uint64)
        keys = mix(self.hashes.of(start, end) + mix(shape))
        # Runs of one leading digit meet in one bucket.
        digit = self.digits[runs]
        return exchange.claims(self.chunk, keys, mix(digit), self.ids[self.owner[runs]], bits, (digit & np.uint64(0xFFFFFFFF)).astype(np.uint32))

    def suffixes(self, runs: np.ndarray, bits: int):
        """Window starts of the runs, their documents, and the claims on them."""
        sizes = self.last[runs] - self.first[runs] + 1
        which = np.repeat(np.arange(len(runs)), sizes)
        ends = np.cumsum(sizes)
        start = self.first[runs][which] + np.arange(len(which)) - (ends - sizes)[which]
        owner = self.owner[runs][which]
        other = Windows(self.values, OTHER_BASE)
        keys, second = self.hashes.of(start, start + self.window), other.of(start, start + self.window)
        return start, owner, exchange.claims(self.chunk, keys, second, self.ids[owner], bits)


def stretch_reply(table: pa.Table) -> pa.Table:
    """Bit 0: an earlier document has the same stretch. Bit 1: the leading digit has other stretches."""
    keys, owners, _, _, _, least, sizes = exchange.smallest(table)
    digits = np.concatenate([np.frombuffer(b, np.uint32) for b in table.column("extra").to_pylist()])
    order = np.lexsort((keys, digits))
    heads = exchange.run_starts(digits[order])
    changes = np.concatenate([[0], np.cumsum(keys[order][1:] != keys[order][:-1])])
    ends = np.concatenate([heads[1:], [len(order)]])
    mixed = np.repeat(changes[ends - 1] > changes[heads], ends - heads)
    flags = (least < owners).astype(np.uint8)
    flags[order] |= mixed.astype(np.uint8) << 1
    return exchange.reply_table(table, sizes, flags)


def _decide(runs: _Runs, replies: pa.Table, bits: int):
    """Runs that repeat an earlier document's, and runs left for the suffix order."""
    live = runs.live(exchange.answers(exchange.question(replies, bits, 0)))
    asked = runs.stretches(live, bits)
    flags = exchange.answers(exchange.question(replies, bits, 1))
    flags = flags[asked.place] if len(live) else flags
    here = asked.owners[asked.place] < runs.ids[runs.owner[live]] if len(live) else np.zeros(0, bool)
    repeated = (flags & 1).astype(bool) | here
    return live[repeated], live[~repeated & (flags & 2).astype(bool)]


def suffix_dedup(docs: DataFrame, window: int = 50, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept: texts without bytes of earlier documents.

    A text is its UTF-8 bytes. A byte goes if a string of `window` bytes that covers it also
    starts in a document with a smaller id; strings are judged on the input. `kept` joins the
    other bytes, so it may cut a character in two.

    A null text has no bytes; texts shorter than the window stay whole. Rows that share an id do
    not act on each other; each is judged and returned. Rows without an id are left out: nothing
    orders them. Other columns are ignored.
    """
    if window < 2:
        raise ValueError("a window has two bytes at least")
    digit = max(1, window * 2 // 5)
    plan = exchange.layout(docs, text)
    bits = plan.bucket_bits
    chunks = exchange.chunked(docs, plan, id_column, text)

    def leading(table: pa.Table) -> pa.Table:
        runs = _Runs(table, window, digit, bits)
        return exchange.count_request(runs.chunk, runs.keys, runs.holders, bits)

    def stretches(table: pa.Table, replies: pa.Table) -> pa.Table:
        runs = _Runs(table, window, digit, bits)
        return runs.stretches(runs.live(exchange.answers(replies)), bits).table

    def suffixes(table: pa.Table, replies: pa.Table) -> pa.Table:
        runs = _Runs(table, window, digit, bits)
        return runs.suffixes(_decide(runs, replies, bits)[1], bits)[2].table

    def cut(table: pa.Table, replies: pa.Table) -> pa.Table:
        runs = _Runs(table, window, digit, bits)
        repeated, left = _decide(runs, replies, bits)
        start, owner, asked = runs.suffixes(left, bits)
        earlier = exchange.answers(exchange.question(replies, bits, 2)).astype(bool)
        gone = earlier[asked.place] | (asked.owners[asked.place] < runs.ids[owner]) if len(start) else np.zeros(0, bool)
        starts = np.concatenate([runs.first[repeated], start[gone]])
        lengths = np.concatenate([runs.last[repeated] + window - runs.first[repeated], np.full(int(gone.sum()), window)])
        bounds, data = runs.texts.bounds, runs.texts.data
        removed = covered(starts, lengths, len(data))
        before = np.concatenate([[False], removed[:-1]])[: len(data)]
        before[bounds[:-1][np.diff(bounds) > 0]] = False
        total = np.concatenate([[0], np.cumsum(removed)])
        heads = np.concatenate([[0], np.cumsum(removed & ~before)])
        n_removed = total[bounds[1:]] - total[bounds[:-1]]
        kept = [data[a:b][~removed[a:b]].tobytes() if n else data[a:b].tobytes() for a, b, n in zip(bounds[:-1], bounds[1:], n_removed)]
        return pa.table(
            {
                "doc_id": pa.array(runs.ids, pa.int64()),
                "n_bytes": pa.array(np.diff(bounds), pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "n_spans": pa.array(heads[bounds[1:]] - heads[bounds[:-1]], pa.int64()),
                "kept": pa.array(kept, pa.binary()),
            }
        )

    first = exchange.ask(chunks, leading, exchange.count_reply)
    second = exchange.next_question(exchange.ask(chunks, stretches, stretch_reply, first), bits, 1)
    known = first.unionByName(second)
    third = exchange.next_question(exchange.ask(chunks, suffixes, exchange.earlier_reply, known), bits, 2)
    return exchange.together(chunks, known.unionByName(third), cut, RESULT)
