"""Scores of the quality model, added up from its tables one lookup at a time."""

from __future__ import annotations

import math
from bisect import bisect_right

import pyarrow as pa
import pytest
from conftest import sentence

from pulseframe.llm import quality_gam


def plain_score(model, x):
    bins = [bisect_right(list(edges), value) for edges, value in zip(model.edges, x)]
    total = model.base + sum(model.tables[j][b] for j, b in enumerate(bins))
    total += sum(table[bins[j]][bins[k]] for (j, k), table in zip(model.pairs, model.pair_tables))
    return 1 / (1 + math.exp(-total))


def test_scores_are_sums_of_table_entries(make_docs, shipped):
    import random

    rng = random.Random(2)
    rows = [(i, sentence(rng, 60) if i % 3 else "@@ 0 0 0 !! " * rng.randrange(2, 30)) for i in range(240)]
    rows += [(None, "no id"), (900, None), (901, ""), (902, "x" * 200_000), (5, "another text under one id")]
    docs = make_docs(rows)
    labels = shipped.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(240)], "doc_id long, quality int, toxic int")
    model = quality_gam.fit_quality(docs, labels)
    assert model.tells_apart
    features = quality_gam.text_features(pa.array([t for _, t in rows]))
    expected = sorted((str(i), plain_score(model, [float(v) for v in x])) for (i, _), x in zip(rows, features))
    found = sorted((str(r.doc_id), r.score) for r in quality_gam.quality_scores(docs, labels).collect())
    assert [i for i, _ in found] == [i for i, _ in expected]
    assert [s for _, s in found] == pytest.approx([s for _, s in expected], abs=1e-9)


def test_nothing_is_rejected_without_labels_of_both_kinds(make_docs, shipped):
    docs = make_docs([(1, "some text"), (2, None), (None, "more")])
    for labels in ([], [(1, 0, 0), (2, 0, 0)]):
        table = shipped.createDataFrame(labels, "doc_id long, quality int, toxic int")
        assert quality_gam.quality_filter(docs, table).count() == 3
