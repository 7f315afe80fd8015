"""Circulant MinHash near-dedup, against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from brute import FOLD, WHITE_WORDS
from conftest import sentence

from pulseframe.llm import minhash_dedup as near


def all_pairs(rows, percent=85, size=5):
    """{(id, set size, component, kept)}; rows of one id are one document to the links."""
    sets = []
    for i, t in rows:
        w = WHITE_WORDS.findall((t or "").translate(FOLD))
        sets.append((i, {tuple(w[s : s + size]) for s in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())))
    above = {i: i for i, _ in sets if i is not None}

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[n + 1 :]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = top(i), top(j)
                above[max(x, y)] = min(x, y)
    return sorted((i is None, i or 0, len(s), None if i is None else top(i), i is None or top(i) == i) for i, s in sets)


def run(df, **settings):
    out = near.minhash_dedup(df, **settings)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept", "class_id"]
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in out.collect())


def test_odd_rows(make_docs, odd_rows):
    rows = [*odd_rows, (None, "a row without an id is kept as it is"), (None, None), (None, "a row without an id is kept as it is")]
    assert run(make_docs(rows)) == all_pairs(rows)


def test_repeated_ids_and_rows(make_docs):
    rng = random.Random(3)
    a, b, c = (sentence(rng, 60) for _ in range(3))
    rows = [(5, a), (5, b), (9, a), (9, a), (12, b), (1, c), (7, c + " end"), (5, None), (2, "")]
    assert run(make_docs(rows)) == all_pairs(rows)


@pytest.mark.parametrize("bands", [(1, 40), (3, 30)])
def test_false_candidates_and_chains(make_docs, monkeypatch, bands):
    """Template texts meet in many buckets without links; chains link through neighbours only."""
    monkeypatch.setattr(near, "GROUP_SIZE", 3)
    monkeypatch.setattr(near, "ASKING", 2)
    rng = random.Random(8)
    frame = sentence(rng, 50)
    rows = [(k, frame + " " + sentence(rng, rng.choice([4, 9, 25, 50]))) for k in range(40)]
    words = sentence(rng, 80).split()
    for k in range(25):
        rows.append((100 + k, " ".join(words)))
        words[3 * k] = f"other{k}"
    assert run(make_docs(rows), rows=bands[0], bands=bands[1]) == all_pairs(rows)


def test_a_long_text_without_spaces(make_docs):
    rows = [(1, "x" * 3_000_000), (2, "x" * 3_000_000), (3, "word " * 400_000), (4, "short")]
    assert run(make_docs(rows)) == [(False, 1, 1, 1, True), (False, 2, 1, 1, False), (False, 3, 1, 3, True), (False, 4, 1, 4, True)]


def test_empty_table(make_docs):
    assert run(make_docs([])) == []


def test_coordinates_estimate_similarity():
    """Shifts of one permutation are as good as permutations of their own."""
    rng = np.random.default_rng(5)
    tokens = rng.integers(0, 1 << 63, 1200, dtype=np.uint64)
    sets = [tokens[:800], tokens[200:1000], tokens[400:]]
    got = near.signature(np.concatenate(sets), np.array([0, 800, 1600]), 2000)
    for i, j, share in ((0, 1, 0.6), (0, 2, 1 / 3), (1, 2, 0.6)):
        assert abs((got[:, i] == got[:, j]).mean() - share) < 0.06


def test_rank_is_a_permutation():
    places = np.arange(1 << 20, dtype=np.uint32) * np.uint32(4093)
    assert len(np.unique(near._rank(places.copy()))) == len(places)
