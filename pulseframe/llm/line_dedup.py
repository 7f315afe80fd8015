"""Removal of line blocks that a document shares with an earlier one, by patience alignment.

Overlapping documents are found through rare lines: each document is aligned with the first holder
of each of its rare lines, so that pairs stay in proportion to the lines however many
documents hold one. What that leaves is aligned with every other earlier holder: not one by one, but
once for each form that the earlier documents take when lines foreign to the open ones are blanked. Two line sequences are aligned on the lines that occur once in both, kept in
order, and between those again; aligned lines that follow each other in both documents are a block.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseframe.llm import exchange
from pulseframe.llm.rolling import BYTE_VALUES, OTHER_BASE, Texts, Windows, Words, mix
from pulseframe.staging import stage

SEQUENCES = "chunk int, doc_id long, row int, partners array<long>, lines array<long>, places array<int>, sizes array<int>, asked array<int>"
REMOVALS = "chunk int, doc_id long, row int, gone array<int>"
WANTED = "line long, open boolean"
FORMS = "lines array<long>, places array<int>, doc_id long"
RESULT = "doc_id long, n_lines long, n_removed long, n_blocks long, kept string"

#: Lines of open documents, and lines of forms, that are sent to all tasks at a time.
OPEN_LINES, FORM_LINES = 2_000_000, 250_000

HOLDER = np.dtype([("owner", "<i8"), ("count", "u1")])


def patience(left: Sequence, right: Sequence) -> list[tuple[int, int]]:
    """Places (i, j) of aligned equal items, ascending in both.

    Equal heads and tails of a range are aligned; between them the items that occur once on both
    sides are, along their longest ascending chain, and the ranges between those in turn. A range
    without such items stays unaligned.
    """
    found: list[tuple[int, int]] = []
    todo = [(0, len(left), 0, len(right))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and left[a] == right[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and left[b - 1] == right[d - 1]:
            b, d = b - 1, d - 1
            found.append((b, d))
        if a == b or c == d:
            continue
        here, there = Counter(left[a:b]), Counter(right[c:d])
        at = {right[j]: j for j in range(c, d) if there[right[j]] == 1}
        both = [(i, at[left[i]]) for i in range(a, b) if here[left[i]] == 1 and left[i] in at]
        if not both:
            continue
        ends: list[int] = []
        last: list[int] = []
        before: list[int] = []
        for k, (_, j) in enumerate(both):
            n = bisect_left(ends, j)
            before.append(last[n - 1] if n else -1)
            if n == len(ends):
                ends.append(j)
                last.append(k)
            else:
                ends[n], last[n] = j, k
        chain, k = [], last[-1]
        while k >= 0:
            chain.append(both[k])
            k = before[k]
        i, j = a, c
        for m, n in reversed(chain):
            todo.append((i, m, j, n))
            found.append((m, n))
            i, j = m + 1, n + 1
        todo.append((i, b, j, d))
    return sorted(found)


def aligned_blocks(mine: Sequence, places: Sequence[int], sizes: Sequence[int], theirs: Sequence, their_places: Sequence[int], least_chars: int) -> list[list[int]]:
    """Places in the first sequence of each common block of `least_chars` bytes or more."""
    blocks: list[list[int]] = []
    weight: list[int] = []
    previous = (-2, -2)
    for i, j in patience(mine, theirs):
        here = (places[i], their_places[j])
        if here == (previous[0] + 1, previous[1] + 1):
            blocks[-1].append(here[0])
            weight[-1] += sizes[i]
        else:
            blocks.append([here[0]])
            weight.append(sizes[i])
        previous = here
    return [b for b, w in zip(blocks, weight) if w >= least_chars]


def _lists(part: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the bounds of its rows."""
    column = part.column(name)
    size = column.value_lengths().to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(size)])


def _form(lines: np.ndarray, places: np.ndarray, known: np.ndarray, blank: int) -> tuple[list[int], list[int]]:
    """A sequence as documents with the known lines see it: others are one blank, and only steps to the next place are told apart."""
    kept = known | np.concatenate([[True], known[:-1]])
    lines, places = np.where(known, lines, blank)[kept], places[kept]
    step = np.where(np.diff(places) == 1, 1, 2)
    return lines.tolist(), np.concatenate([[0], np.cumsum(step)]).tolist()


class _Forms:
    """Forms of earlier documents, shortest first, and which of them hold a line."""

    def __init__(self, table: pa.Table):
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("lines", "places", "doc_id"))), key=lambda r: (len(r[0]), r))
        self.lines, self.places = [r[0] for r in rows], [r[1] for r in rows]
        self.ids = np.array([r[2] for r in rows], np.int64)
        self.once = [_once(v) for v in self.lines]
        holders: dict[int, list[int]] = {}
        for n, v in enumerate(self.lines):
            for x in set(v):
                holders.setdefault(x, []).append(n)
        self.holders = {x: np.array(v) for x, v in holders.items()}

    def of(self, lines: set[int], before: int) -> np.ndarray:
        held = [self.holders[x] for x in lines if x in self.holders]
        found = np.unique(np.concatenate(held)) if held else np.empty(0, np.int64)
        return found[self.ids[found] < before]


def _once(lines: Sequence[int]) -> frozenset:
    return frozenset(x for x, n in Counter(lines).items() if n == 1)


class _Lines:
    """Lines of a chunk that hold a word: key, document, number among the document's such lines, size."""

    def __init__(self, table: pa.Table):
        self.rows = exchange.in_order(table)
        self.ids = exchange.column(self.rows, "doc_id")
        self.chunk = int(self.rows.column("chunk")[0].as_py())
        texts = Texts(self.rows.column("text"))
        words = Words(texts)
        breaks = np.flatnonzero(texts.data == 0x0A)
        edges = np.unique(np.concatenate([texts.bounds, breaks + 1]))
        at = np.searchsorted(words.start, edges)
        holds = np.flatnonzero(np.diff(at) > 0)
        start, end = words.start[at[holds]], words.end[at[holds + 1] - 1]
        values = BYTE_VALUES[texts.data]
        self.keys = Windows(values).of(start, end)
        self.second = Windows(values, OTHER_BASE).of(start, end)
        self.owner = np.searchsorted(texts.bounds, start, "right") - 1
        self.bounds = np.searchsorted(self.owner, np.arange(texts.n + 1))
        self.place = np.arange(len(start)) - self.bounds[self.owner]
        self.size = end - start
        self.asked_keys, self.asked_second, self.asked_owner = self.keys, self.second, self.owner

    def runs(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last line of the shortest runs of several lines that reach `least` bytes, forward from each short line and backward.

        A block of that size has each of its lines in such a run of the block, or is itself of one long enough line.
        """
        n = len(self.size)
        total = np.concatenate([[0], np.cumsum(self.size)])
        line = np.arange(n)
        to = np.searchsorted(total, total[:-1] + least) - 1
        back = np.searchsorted(total, total[1:] - least, "right") - 1
        lo, hi = self.bounds[self.owner], self.bounds[self.owner + 1]
        forward, backward = (to > line) & (to < hi), (back < line) & (back >= lo)
        first, last = np.concatenate([line[forward], back[backward]]), np.concatenate([to[forward], line[backward]])
        pairs = np.unique(np.stack([first, last]), axis=1)
        return pairs[0], pairs[1]

    def with_runs(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Adds the runs' keys behind those of the lines, for claims; gives the runs."""
        first, last = self.runs(least)
        made = []
        for keys in (self.keys, self.second):
            run = np.ones(len(first), np.uint64)
            for k in range(int((last - first).max(initial=-1)) + 1):
                on = first + k <= last
                run[on] = mix((run[on] * OTHER_BASE) ^ keys[first[on] + k])
            made.append(run)
        self.asked_keys, self.asked_second = np.concatenate([self.keys, made[0]]), np.concatenate([self.second, made[1]])
        self.asked_owner = np.concatenate([self.owner, self.owner[first]])
        return first, last

    def claims(self, bits: int) -> exchange.Claims:
        """One claim for each distinct line or run of a document, so that counts are of documents."""
        order = np.lexsort((self.asked_keys, self.asked_owner))
        keys, owner = self.asked_keys[order], self.asked_owner[order]
        fresh = np.concatenate([[True], (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])])[: len(order)]
        once = order[fresh]
        asked = exchange.claims(self.chunk, self.asked_keys[once], self.asked_second[once], self.ids[self.asked_owner[once]], bits)
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(fresh) - 1
        return exchange.Claims(asked.table, asked.place[number] if len(number) else number, asked.owners)


def line_dedup(
    docs: DataFrame,
    few: int = 8,
    rarest: float = 0.5,
    least_chars: int = 20,
    id_column: str = "doc_id",
    text: str = "text",
    carry: Sequence[str] = (),
    every: bool = True,
) -> DataFrame:
    """doc_id, n_lines, n_removed, n_blocks, kept: texts without blocks aligned with an earlier document.

    Lines end at a line feed and are compared without white space at their ends; blank lines count
    as no line. A line is rare for a document if at most `few` documents hold it or it
    is among the `rarest` share of the document's distinct lines. The document is aligned with the
    smallest id that holds one of its rare lines, for each of them that has `least_chars` bytes and
    a holder with a smaller id. With `every`, all lines count as rare, however many documents hold
    them, and those left over are aligned with every other holder with a smaller id: the result is
    that of an alignment with all earlier documents. Runs of shorter lines that have `least_chars` bytes
    together name partners too. Lines of one document alone take no part in the alignment, but end a
    block. Aligned blocks of at least `least_chars` bytes go, judged on
    the input; `kept` has the other lines, blank ones included. Unchanged texts are kept as they are.

    A null or blank text has no lines; the text of a null is empty. Rows that share an id do not
    act on each other; each is judged and returned. Rows without an id are left out: nothing orders
    them. The columns named by `carry` come along as they are, in a struct `rest`; others are ignored.
    """
    plan = exchange.layout(docs, text)
    bits = plan.bucket_bits
    chunks = exchange.chunked(docs, plan, id_column, text, carry)

    def request(table: pa.Table) -> pa.Table:
        lines = _Lines(table)
        if every:
            lines.with_runs(least_chars)
        return lines.claims(bits).table

    def sequences(table: pa.Table, replies: pa.Table) -> pa.Table:
        lines = _Lines(table)
        first_of, last_of = lines.with_runs(least_chars) if every else (np.empty(0, np.int64),) * 2
        held = exchange.answers(replies, HOLDER)[lines.claims(bits).place]
        out: dict[str, list] = {name: [] for name in ("doc_id", "row", "partners", "lines", "places", "sizes", "asked")}
        # Runs in order of their first line.
        runs = np.searchsorted(first_of, lines.bounds)
        for i, (lo, hi) in enumerate(zip(lines.bounds[:-1], lines.bounds[1:])):
            count, holder = held["count"][lo:hi], held["owner"][lo:hi]
            shared = np.flatnonzero(count > 1)
            if not len(shared):
                continue
            _, first = np.unique(lines.keys[lo:hi], return_index=True)
            rank = first[np.lexsort((first, count[first]))]
            rare = count <= few
            rare[rank[: int(np.ceil(rarest * len(rank)))]] = True
            rare |= every
            proof = rare & (count > 1) & (holder < lines.ids[i]) & (lines.size[lo:hi] >= least_chars)
            run = held[len(lines.keys) + runs[i] : len(lines.keys) + runs[i + 1]]
            earlier_run = run["owner"] < lines.ids[i]
            # The second of two holders has no other to ask.
            asked = proof & (count > 2)
            for at in runs[i] + np.flatnonzero(earlier_run & (run["count"] > 2)):
                asked[first_of[at] - lo : last_of[at] - lo + 1] = True
            out["asked"].append(lines.place[lo:hi][asked].astype(np.int32))
            out["doc_id"].append(int(lines.ids[i]))
            out["row"].append(i)
            out["partners"].append(np.unique(np.concatenate([holder[proof], run["owner"][earlier_run]])))
            out["lines"].append(lines.keys[lo:hi][shared].view(np.int64))
            out["places"].append(lines.place[lo:hi][shared].astype(np.int32))
            out["sizes"].append(lines.size[lo:hi][shared].astype(np.int32))
        kinds = {"doc_id": pa.int64(), "row": pa.int32(), "partners": pa.list_(pa.int64()), "lines": pa.list_(pa.int64())}
        columns = {name: pa.array(values, kinds.get(name, pa.list_(pa.int32()))) for name, values in out.items()}
        return pa.table({"chunk": pa.array([lines.chunk] * len(out["row"]), pa.int32()), **columns})

    def align(parts):
        for part in parts:
            rows = part.to_pylist()
            gone = [
                [p for block in aligned_blocks(r["lines"], r["places"], r["sizes"], r["their_lines"], r["their_places"], least_chars) for p in block]
                for r in rows
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column("chunk"), part.column("doc_id"), part.column("row"), pa.array(gone, pa.list_(pa.int32()))],
                names=["chunk", "doc_id", "row", "gone"],
            )

    def cut(table: pa.Table, removals: pa.Table) -> pa.Table:
        rows = exchange.in_order(table)
        gone_of: dict[int, set] = {}
        for r in removals.select(["row", "gone"]).to_pylist():
            gone_of.setdefault(r["row"], set()).update(r["gone"])
        n_lines, n_removed, n_blocks, kept = [], [], [], []
        for i, text_ in enumerate(rows.column("text").to_pylist()):
            lines = (text_ or "").split("\n")
            gone, place, rest, blocks, inside = gone_of.get(i, set()), 0, [], 0, False
            for line in lines:
                # Only ASCII white space makes a line blank.
                if not line.strip(" \t\r\x0b\x0c"):
                    rest.append(line)
                    continue
                out = place in gone
                blocks += out and not inside
                inside = out
                if not out:
                    rest.append(line)
                place += 1
            n_lines.append(place)
            n_removed.append(len(gone))
            n_blocks.append(blocks)
            kept.append("\n".join(rest) if gone else text_ or "")
        done = pa.table(
            {
                "doc_id": rows.column("doc_id"),
                "n_lines": pa.array(n_lines, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "n_blocks": pa.array(n_blocks, pa.int64()),
                "kept": pa.array(kept, pa.string()),
            }
        )
        return done.append_column("rest", rows.column("rest")) if carry else done

    def wanted(parts):
        for part in parts:
            (lines, bounds), (places, _), (open_, at) = (_lists(part, c) for c in ("lines", "places", "open"))
            flags = [np.isin(places[a:b], open_[c:d]) for a, b, c, d in zip(bounds[:-1], bounds[1:], at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(lines), pa.array(np.concatenate([*flags, np.empty(0, bool)]))], names=["line", "open"])

    def others(left: DataFrame, found: DataFrame) -> list[DataFrame]:
        """Removals of the open documents against every form that earlier documents with one of their open lines take."""
        known = left.mapInArrow(wanted, WANTED).groupBy("line").agg(F.max("open").alias("open")).toArrow().sort_by("line")
        lines, is_open = exchange.column(known, "line"), exchange.column(known, "open")
        blank = next(x for x in range(len(lines) + 1) if not (lines == x).any())
        sent = context.broadcast((lines, is_open.astype(bool), blank))

        def forms(parts):
            lines, is_open, blank = sent.value
            for part in parts:
                (theirs, bounds), (places, _) = _lists(part, "lines"), _lists(part, "places")
                at = np.minimum(np.searchsorted(lines, theirs), len(lines) - 1)
                known = lines[at] == theirs
                hits = np.concatenate([[0], np.cumsum(known & is_open[at])])[bounds]
                chosen = np.flatnonzero(np.diff(hits))
                made = [_form(theirs[a:b], places[a:b], known[a:b], blank) for a, b in zip(bounds[chosen], bounds[chosen + 1])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([m[0] for m in made], pa.list_(pa.int64())), pa.array([m[1] for m in made], pa.list_(pa.int32())), part.column("doc_id").take(pa.array(chosen))],
                    names=["lines", "places", "doc_id"],
                )

        shapes = found.select("doc_id", "lines", "places").mapInArrow(forms, FORMS).groupBy("lines", "places").agg(F.min("doc_id").alias("doc_id"))
        shapes = stage(shapes, "line-forms")
        turns = max(1, -(-(shapes.agg(F.sum(F.size("lines")).alias("n")).first()["n"] or 0) // FORM_LINES))
        turn = F.pmod(F.xxhash64("lines", "places"), F.lit(turns))
        return [left.mapInArrow(tried(context.broadcast(shapes.where(turn == n).toArrow())), REMOVALS) for n in range(turns)]

    def tried(sent):
        def work(parts):
            built = _Forms(sent.value)
            for part in parts:
                gone = []
                for r in part.to_pylist():
                    open_, found = set(r["open"]), set()
                    once = _once(r["lines"])
                    for n in built.of({x for x, p in zip(r["lines"], r["places"]) if p in open_}, r["doc_id"]):
                        theirs = built.lines[n]
                        # Without an equal end or a line that is single on both sides nothing is aligned.
                        if theirs[0] == r["lines"][0] or theirs[-1] == r["lines"][-1] or not once.isdisjoint(built.once[n]):
                            for block in aligned_blocks(r["lines"], r["places"], r["sizes"], theirs, built.places[n], least_chars):
                                found.update(block)
                            if open_ <= found:
                                break
                    gone.append(sorted(found))
                yield pa.RecordBatch.from_arrays(
                    [part.column("chunk"), part.column("doc_id"), part.column("row"), pa.array(gone, pa.list_(pa.int32()))],
                    names=["chunk", "doc_id", "row", "gone"],
                )

        return work

    context = docs.sparkSession.sparkContext
    holders = exchange.ask(chunks, request, exchange.holder_reply)
    found = stage(exchange.together(chunks, holders, sequences, SEQUENCES), "line-sequences")
    later = found.select("chunk", "doc_id", "row", "lines", "places", "sizes", F.explode("partners").alias("partner"))
    earlier = found.select(F.col("doc_id").alias("partner"), F.col("lines").alias("their_lines"), F.col("places").alias("their_places"))
    removals = later.join(earlier, "partner").mapInArrow(align, REMOVALS)
    if every:
        removals = stage(removals, "line-removals")
        gone = removals.groupBy("chunk", "row").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))
        left = found.where(F.size("asked") > 0).drop("partners").join(gone, ["chunk", "row"], "left")
        left = left.withColumn("open", F.array_except("asked", F.coalesce("gone", F.array().cast("array<int>")))).where(F.size("open") > 0)
        left = stage(left.drop("asked", "gone"), "open-lines")
        turns = -(-(left.agg(F.sum(F.size("lines")).alias("n")).first()["n"] or 0) // OPEN_LINES)
        for n in range(turns):
            for more in others(left.where(F.pmod(F.xxhash64("doc_id"), F.lit(turns)) == n), found):
                removals = removals.unionByName(more)
    result = T.StructType.fromDDL(RESULT)
    if carry:
        result.add(chunks.schema["rest"])
    return exchange.together(chunks, removals, cut, result)
