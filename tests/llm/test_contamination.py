"""Benchmark decontamination, against a plain version and as a plan."""

from __future__ import annotations

import random

import brute
import pytest
from conftest import sentence
from pyspark.sql import functions as F

from pulseframe.llm import decontamination, queries


def digest(df):
    shown = df.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256),
        decontamination.is_contaminated(F.col("n_hit"), F.col("n_words")),
    )
    return sorted(map(tuple, shown.collect()))


def cases(seed=2):
    rng = random.Random(seed)
    items = [(k, sentence(rng, rng.choice([1, 4, 12, 13, 14, 40]))) for k in range(12)]
    items += [(20, None), (21, ""), (22, "?!"), (23, items[5][1]), (None, "alone"), (24, "Émile Zola écrit")]
    rows = [(k, sentence(rng, rng.randrange(80))) for k in range(20)]
    for k, (_, t) in enumerate(items):
        words = (t or "").upper().replace(" ", "; ")
        rows.append((100 + k, sentence(rng, rng.randrange(200)) + " " + words + " " + sentence(rng, 30)))
    rows += [(200, None), (201, ""), (202, "..."), (203, items[0][1]), (204, "émile zola écrit"), (205, "ÉMILE zola écrit")]
    return rows, items


@pytest.mark.parametrize("most", [1_000_000, -1])
def test_as_plain_version(make_docs, shipped, monkeypatch, most):
    monkeypatch.setattr(decontamination, "MOST_BROADCAST", most)
    rows, items = cases()
    rows += [(7, rows[25][1]), (7, rows[25][1]), (None, rows[25][1])]
    benchmark = shipped.createDataFrame(items, "item_id long, text string")
    assert digest(decontamination.find_contamination(make_docs(rows), benchmark)) == sorted(brute.contamination(rows, items))


def test_long_texts(make_docs, shipped):
    rng = random.Random(4)
    item = sentence(rng, 50)
    rows = [(1, " ".join(sentence(rng, 1000) for _ in range(20)) + " " + item), (2, item * 3)]
    benchmark = shipped.createDataFrame([(1, item)], "item_id long, text string")
    assert digest(decontamination.find_contamination(make_docs(rows), benchmark)) == sorted(brute.contamination(rows, [(1, item)]))


def test_empty_tables(make_docs, shipped):
    none = shipped.createDataFrame([], "item_id long, text string")
    assert decontamination.find_contamination(make_docs([]), none).count() == 0
    assert digest(decontamination.find_contamination(make_docs([(1, "a b")]), none)) == [(1, 2, 0, 0, brute.sha(b""), False)]


def test_decontaminate_keeps_columns(make_docs, shipped):
    rows, items = cases()
    docs = make_docs(rows + [(None, items[5][1])])
    left = decontamination.decontaminate(docs, shipped.createDataFrame(items, "item_id long, text string"))
    bad = {r[0] for r in brute.contamination(rows, items) if r[5]}
    assert left.columns == docs.columns
    assert bad and {r.doc_id for r in left.collect()} == {i for i, _ in rows if i not in bad} | {None}


def test_runs_in_the_engine_alone(shipped, small):
    plan = queries.op4_benchmark_decontamination(shipped, small)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
