"""Line dedup as op10 runs it, against alignment with all earlier documents."""

from __future__ import annotations

import random

import brute
import pytest

from pulseframe.llm import line_dedup, queries
from pulseframe.llm.line_dedup import aligned_blocks


def aligned_with_all(rows, least=20):
    """(id, n_lines, n_removed); every document is aligned with each that has a smaller id."""
    split = [(i, [x for x in (y.strip(" \t\r\x0b\x0c") for y in t.split("\n")) if x]) for i, t in brute.named(rows)]
    held = [x for _, v in split for x in set(v)]
    once = {x for x in held if held.count(x) == 1}
    shared = lambda v: [p for p, x in enumerate(v) if x not in once]
    out = []
    for i, v in split:
        at, gone = shared(v), set()
        for j, w in split:
            there = shared(w)
            if j < i and at and there:
                sizes = [len(v[p].encode()) for p in at]
                gone.update(p for block in aligned_blocks([v[p] for p in at], at, sizes, [w[p] for p in there], there, least) for p in block)
        out.append((i, len(v), len(gone)))
    return sorted(out)


@pytest.fixture
def op10(make_docs, shipped, tmp_path):
    def run(rows):
        make_docs(rows).select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
        return sorted((r.doc_id, r.n_lines, r.n_removed) for r in queries.op10_line_dedup(shipped, str(tmp_path)).collect())

    return run


def lines(name, n):
    return [f"line {k} of {name}, long enough to count" for k in range(n)]


def text(*parts):
    return "\n".join(x for part in parts for x in part)


def test_passage_of_many_documents(op10):
    rows = [(k, text(lines(f"own {k}", 12), lines("the passage", 10), lines(f"end {k}", 12))) for k in range(12)]
    found = op10(rows)
    assert found == aligned_with_all(rows)
    assert [gone for _, _, gone in found] == [0] + [10] * 11


def test_passages_in_another_order_than_at_their_first_holder(op10):
    x, y = lines("x", 5), lines("y", 5)
    rows = [(1, text(y, x)), (2, text(x, y)), (3, text(x, y)), (4, text(lines("own", 3), x, y))]
    found = op10(rows)
    assert found == aligned_with_all(rows)
    assert [gone for _, _, gone in found] == [0, 5, 10, 10]


@pytest.mark.parametrize("at_once", [250_000, 3])
def test_lines_repeated_within_documents(op10, monkeypatch, at_once):
    monkeypatch.setattr(line_dedup, "OPEN_LINES", at_once * 8)
    monkeypatch.setattr(line_dedup, "FORM_LINES", at_once * 8)
    rng = random.Random(at_once)
    pool = lines("the pool", 7)
    rows = [(k, "\n".join(rng.choice(pool) if rng.random() < 0.7 else f"a line of document {k} alone {n}" for n in range(rng.randrange(9)))) for k in range(60)]
    assert op10(rows) == aligned_with_all(rows)


def test_short_lines(op10):
    verse = [f"word {k} é" for k in range(30)]
    rows = [(1, "\n".join(verse)), (2, "\n".join(verse)), (3, text(["own"], verse[4:9], ["}"], verse[9:11]))]
    # A long line at first holder 4 alone, with short lines after it elsewhere.
    rows += [(4, text(lines("q", 1), ["other"])), (5, text(lines("q", 1), ["a", "b", "c"])), (6, text(lines("q", 1), ["a", "b", "c"]))]
    found = op10(rows)
    assert found == aligned_with_all(rows)
    assert [gone for _, _, gone in found] == [0, 30, 5, 0, 1, 4]


def test_random_short_lines(op10):
    rng = random.Random(4)
    pool = ["}", "{", "end", "return x", "x = 1", "a line of some length", "for k in v:"]
    rows = [(k, "\n".join(rng.choice(pool) if rng.random() < 0.85 else f"u{k}.{n}" for n in range(rng.randrange(14)))) for k in range(70)]
    assert op10(rows) == aligned_with_all(rows)
