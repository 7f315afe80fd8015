"""Ranked lexical search, against all scores."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from brute import FOLD
from conftest import sentence

from pulseframe.llm import lexical_search as lexical

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def all_scores(rows, queries, k=20):
    held = [(i, Counter(TERMS.findall((t or "").translate(FOLD)))) for i, t in rows]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(term for _, c in held for term in c)
    out = []
    for name, text in queries:
        if name is None:
            continue
        asked = Counter(TERMS.findall((text or "").translate(FOLD)))
        scores = []
        for i, c in held:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // n_terms
            score = sum(
                n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t, n in asked.items()
                if t in c
            )
            if score > 0 and i is not None:
                scores.append((-score, i))
        out += [(name, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def run(spark, docs, queries, **settings):
    asked = spark.createDataFrame([(n, t, 1, "x") for n, t in queries], "item_id string, text string, score int, term string")
    out = lexical.lexical_search(docs, asked, **settings)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, out.collect()))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    rows = [(k, sentence(rng, rng.choice([3, 20, 20, 80]))) for k in range(300)]
    # Copies tie, one length is very common, and one term is in every text.
    rows += [(400 + k, "alpha beta the same words in each copy") for k in range(60)]
    rows += [(None, sentence(rng, 30)), (500, None), (501, ""), (502, "-- !!"), (503, "ÉCOLE École école Q1 q1"), (7, "alpha twice under one id"), (504, "zeta " * 5000)]
    queries = [(f"q{k}", sentence(rng, 12)) for k in range(7)]
    queries += [("same", "alpha beta copy"), ("same", "alpha beta copy"), ("none", "unheardof"), ("blank", ""), (None, "alpha"), ("null", None), ("accents", "École q1 Q1 q1")]
    return rows, queries


@pytest.mark.parametrize("shards", [4096, 50])
@pytest.mark.parametrize("most", [2_000_000, 3])
def test_search(shipped, make_docs, corpus, monkeypatch, shards, most):
    """`most` 3: too many query terms to send, so every posting is kept; small shards and turns."""
    monkeypatch.setattr(lexical, "SHARD_DOCUMENTS", shards)
    monkeypatch.setattr(lexical, "MOST_TERMS", most)
    monkeypatch.setattr(lexical, "QUERIES_TOGETHER", 4 if shards == 50 else 256)
    rows, queries = corpus
    assert run(shipped, make_docs(rows), queries) == all_scores(rows, queries)


def test_few_results(shipped, make_docs, corpus):
    rows, queries = corpus
    assert run(shipped, make_docs(rows), queries, k=1) == all_scores(rows, queries, 1)


def test_large_weights_stay_exact(shipped, make_docs):
    """Scores beyond 2**53: the same term is asked millions of times."""
    rows = [(1, "beta alpha gamma"), (2, "alpha"), (3, "beta beta")]
    queries = [("much", "alpha " * 1_500_000 + "beta " * 700_001)]
    assert run(shipped, make_docs(rows), queries) == all_scores(rows, queries)


def test_empty_tables(shipped, make_docs):
    assert run(shipped, make_docs([]), [("q", "alpha")]) == []
    assert run(shipped, make_docs([(1, "alpha")]), []) == []
    assert run(shipped, make_docs([(1, None)]), [("q", "alpha")]) == []


def test_strata_are_skipped():
    """A query that is answered by short documents never opens the postings of long ones."""
    term = np.array([5], np.uint64).tobytes()
    n = [2] * 30 + [100_000] * 200
    table = pa.table({"shard": pa.array([0] * 230, pa.int32()), "doc_id": list(range(230)), "n": n, "terms": [term] * 230, "tf": [np.array([1], np.uint32).tobytes()] * 230})
    shard = lexical.Shard(lexical._shard_index(table, 230, sum(n)).to_pylist()[0])
    assert len(shard.m) == 2
    opened = []

    class Watched(np.ndarray):
        def __getitem__(self, at):
            opened.append(np.size(at))
            return np.asarray(super().__getitem__(at))

    shard.impacts = shard.impacts.view(Watched)
    place, _ = shard.best(np.array([5], np.uint64), np.array([10]), 10, 1)
    assert sorted(place) == list(range(30)) and sum(opened) == 30
