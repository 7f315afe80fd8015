"""Removal of passages that repeat across documents, by difference-cover anchors.

A passage is a window of `window` words. Windows are hashed only at positions that lie in a
difference cover modulo a period v: for any two starts there is a shift k < v that brings both
to cover positions, so two equal windows share an anchor of window - v + 1 words at the same
place within them. Anchors held by one document alone end there. Around the others the windows
that contain them are compared whole, which is the extension of a match to its full length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pulseframe.llm import exchange
from pulseframe.llm.rolling import OTHER_BASE, Texts, Windows, Words, covered, positions

#: Perfect difference sets; every residue modulo the period is a difference of two members.
COVERS = {
    1: (0,),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 4, 14, 16),
    31: (0, 1, 3, 8, 12, 18),
}

RESULT = "doc_id long, n_words long, n_removed long, n_spans long, kept string"


def period_for(window: int) -> int:
    """The longest period that leaves an anchor of at least a third of the window."""
    return max(v for v in COVERS if v == 1 or window - v + 1 >= max(2, window // 3))


class _Anchors:
    """Anchors of a chunk: keys in the order of the first question, and where each stands."""

    def __init__(self, table: pa.Table, window: int, bits: int):
        self.rows = exchange.in_order(table)
        self.ids = exchange.column(self.rows, "doc_id")
        self.chunk = int(self.rows.column("chunk")[0].as_py())
        self.texts = Texts(self.rows.column("text"))
        self.words = Words(self.texts)
        self.period = period_for(window)
        length = window - self.period + 1
        start, owner = positions(self.words.bounds, length)
        cover = np.zeros(self.period, dtype=bool)
        cover[list(COVERS[self.period])] = True
        chosen = cover[(start - self.words.bounds[owner]) % self.period]
        self.start, self.owner = start[chosen], owner[chosen]
        keys = Windows(self.words.hashes).of(self.start, self.start + length)
        self.keys, self.place, _ = exchange.distinct(keys, bits)
        low = np.full(len(self.keys), len(self.ids), np.int64)
        high = np.full(len(self.keys), -1, np.int64)
        np.minimum.at(low, self.place, self.owner)
        np.maximum.at(high, self.place, self.owner)
        self.holders = np.where(low == high, 1, 2)


def _repeated(anchors: _Anchors, levels: np.ndarray, window: int):
    """Starts of all windows that contain a shared anchor, and their documents."""
    shared = (levels >= 2)[anchors.place] if len(levels) else np.zeros(len(anchors.place), bool)
    bounds = anchors.words.bounds
    at, owner = anchors.start[shared], anchors.owner[shared]
    first = np.maximum(at - anchors.period + 1, bounds[owner])
    marked = covered(first, at + 1 - first, len(anchors.words.start))
    start, owner = positions(bounds, window)
    return start[marked[start]], owner[marked[start]]


def _claims(anchors: _Anchors, levels: np.ndarray, window: int, bits: int):
    start, owner = _repeated(anchors, levels, window)
    end = start + window
    keys = Windows(anchors.words.hashes).of(start, end)
    second = Windows(anchors.words.hashes, OTHER_BASE).of(start, end)
    return start, owner, exchange.claims(anchors.chunk, keys, second, anchors.ids[owner], bits)


def substring_dedup(docs: DataFrame, window: int = 50, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, n_spans, kept: texts without passages of earlier documents.

    Words are runs of characters other than ASCII white space. A word goes if it lies in a window
    of `window` words that also starts in a document with a smaller id; windows are judged on the
    input. `kept` has the other words, joined by one space.

    A null or blank text has no words and keeps the empty text. Texts of fewer words than the
    window stay whole. Rows that share an id do not act on each other; each is judged and
    returned. Rows without an id are left out: nothing orders them. Other columns are ignored.
    """
    plan = exchange.layout(docs, text)
    bits = plan.bucket_bits
    chunks = exchange.chunked(docs, plan, id_column, text)

    def anchors_of(table: pa.Table) -> pa.Table:
        a = _Anchors(table, window, bits)
        return exchange.count_request(a.chunk, a.keys, a.holders, bits)

    def windows_of(table: pa.Table, replies: pa.Table) -> pa.Table:
        return _claims(_Anchors(table, window, bits), exchange.answers(replies), window, bits)[2].table

    def cut(table: pa.Table, replies: pa.Table) -> pa.Table:
        a = _Anchors(table, window, bits)
        start, owner, asked = _claims(a, exchange.answers(exchange.question(replies, bits, 0)), window, bits)
        earlier = exchange.answers(exchange.question(replies, bits, 1)).astype(bool)
        gone = earlier[asked.place] | (asked.owners[asked.place] < a.ids[owner]) if len(start) else np.zeros(0, bool)
        removed = covered(start[gone], window, len(a.words.start))
        before = np.concatenate([[False], removed[:-1]]) if len(removed) else removed
        before[a.words.bounds[:-1][a.words.count > 0]] = False
        kept, n_removed, n_spans = [], [], []
        for i, (lo, hi) in enumerate(zip(a.words.bounds[:-1], a.words.bounds[1:])):
            out = removed[lo:hi]
            words = a.texts.bytes_of(i).split()
            n_removed.append(int(out.sum()))
            n_spans.append(int((out & ~before[lo:hi]).sum()))
            kept.append(b" ".join(w for w, o in zip(words, out.tolist()) if not o) if n_removed[-1] else b" ".join(words))
        return pa.table(
            {
                "doc_id": pa.array(a.ids, pa.int64()),
                "n_words": pa.array(a.words.count, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "n_spans": pa.array(n_spans, pa.int64()),
                "kept": pa.array(kept, pa.binary()).cast(pa.string()),
            }
        )

    shared = exchange.ask(chunks, anchors_of, exchange.count_reply)
    earlier = exchange.ask(chunks, windows_of, exchange.earlier_reply, shared)
    both = shared.unionByName(exchange.next_question(earlier, bits, 1))
    return exchange.together(chunks, both, cut, RESULT)
