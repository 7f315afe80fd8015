"""Exact top-k search, against all scores."""

from __future__ import annotations

import random

import numpy as np
import pytest

from pulseframe.llm import top_k

SCHEMA = "vec_id long, embedding array<float>, label int, v string, block string"


def all_scores(rows, queries_, k=10):
    usable = [(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    values = sorted((i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in usable)
    out = []
    for q in {i for i, _ in values} & set(queries_):
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for p, v in values if p == q for i, w in values if i != q and len(w) == len(v))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return out


def run(spark, rows, k=10):
    table = spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], SCHEMA)
    found = top_k.top_k(table, table.where("vec_id % 100 = 0"), k)
    return sorted(map(tuple, found.collect()))


@pytest.fixture(scope="module")
def vectors():
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(16)]) for i in range(420)]
    rows += [(500 + i, rows[3][1]) for i in range(30)] + [(600, rows[3][1]), (700, [0.0] * 16), (701, [0.0] * 16)]
    rows += [(800, None), (801, [None] * 16), (802, [float("nan")] + [1.0] * 15), (803, [float("inf")] * 16), (None, [1.0] * 16)]
    return rows


@pytest.mark.parametrize("block", [4096, 64, 7])
def test_top_k(shipped, vectors, monkeypatch, block):
    monkeypatch.setattr(top_k, "BLOCK_VECTORS", block)
    monkeypatch.setattr(top_k, "QUERIES_TOGETHER", 3 if block == 64 else 4096)
    expected = sorted(all_scores(vectors, {i for i, _ in vectors if i is not None and i % 100 == 0}))
    assert run(shipped, vectors) == expected


def test_few_vectors_and_repeats(shipped):
    rows = [(0, [1.0, 0.5]), (0, [1.0, 0.5]), (1, [0.25, -1.0]), (2, [3.0, 3.0, 3.0])]
    # Repeated rows count each, as queries too.
    assert run(shipped, rows) == [(0, 1, 1, 1024 * 256 - 512 * 1024), (0, 2, 1, 1024 * 256 - 512 * 1024)]
    assert run(shipped, []) == []
    assert run(shipped, [(100, [1.0])]) == []


@pytest.mark.parametrize("size", [2.0**17, 2.0**20 + 1])
def test_large_components_stay_exact(shipped, size):
    """Scores beyond 2**53, whose last digits decide."""
    rng = random.Random(6)
    rows = [(i, [size + rng.randrange(4), -size + rng.randrange(4), rng.random()]) for i in range(60)]
    assert run(shipped, rows) == sorted(all_scores(rows, {0}))
