"""The pipeline's stages, one by one and together."""

from __future__ import annotations

from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from pulseframe.llm import queries as corpus
from pulseframe.staging import stage


def test_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)}
    assert "pipeline" in names and ("pipeline" in entry.oracle_sql()) == (corpus_pipeline.ORACLE_SQL is not None)


@pytest.fixture(scope="module")
def stages(shipped, small):
    docs, out = shipped.read.parquet(f"{small}/documents.parquet"), []
    for _, apply in corpus_pipeline.STAGES:
        before, docs = docs, stage(apply(shipped, docs, small), "test-stage")
        out.append((before, docs))
    return out


def test_columns(stages, shipped, small):
    kinds = shipped.read.parquet(f"{small}/documents.parquet").dtypes
    for _, after in stages[:-1]:
        assert after.dtypes == kinds


def test_quality_stage(stages, shipped, small):
    _, after = stages[0]
    kept = {r.doc_id for r in after.select("doc_id").collect()}
    labels = shipped.read.parquet(f"{small}/labels.parquet").collect()
    good, bad = ([r.doc_id for r in labels if r.quality == q] for q in (1, 0))
    assert sum(i in kept for i in good) >= 0.95 * len(good)
    assert sum(i in kept for i in bad) <= 0.2 * len(bad)


def test_line_stage(stages):
    before, after = ({r.doc_id: r for r in df.collect()} for df in stages[1])
    assert set(after) <= set(before)
    for i, r in after.items():
        assert r.n_chars == len(r.text) and len(r.text) <= len(before[i].text)
        assert (r.lang, r.source) == (before[i].lang, before[i].source)


def test_similar_stage(stages):
    before, after = stages[2]
    groups = brute.similar([(r.doc_id, r.text) for r in before.collect()])
    assert sorted(r.doc_id for r in after.collect()) == sorted({top for _, top in groups.values()})


def test_benchmark_stage(stages, shipped, small):
    before, after = stages[3]
    items = [(r.item_id, r.text) for r in shipped.read.parquet(f"{small}/benchmark.parquet").collect()]
    found = brute.contamination([(r.doc_id, r.text) for r in before.collect()], items)
    assert sorted(r.doc_id for r in after.collect()) == sorted(r[0] for r in found if not r[5])


def test_packing_stage(stages):
    from test_texts import check_packing

    before, after = stages[4]
    check_packing([(r.doc_id, r.text) for r in before.collect()], after.collect())


def test_run_is_the_stages(stages, shipped, small):
    columns = ["doc_id", "piece", "length", "ids_crc32"]
    rows = lambda df: sorted(map(tuple, df.select(columns).collect()))
    assert rows(corpus_pipeline.run(shipped, small)) == rows(stages[-1][1])


@pytest.mark.parametrize("empty", ["documents", "labels"])
def test_empty_tables(shipped, small, tmp_path, empty):
    for name in ("documents", "labels", "benchmark"):
        table = shipped.read.parquet(f"{small}/{name}.parquet")
        (table.limit(0) if name == empty else table).write.parquet(str(tmp_path / f"{name}.parquet"))
    rows = corpus_pipeline.run(shipped, str(tmp_path)).count()
    # Without labels nothing is rejected for its quality.
    assert (rows == 0) == (empty == "documents")


def test_rows_without_an_id_and_rows_that_share_one_stay(make_docs, shipped, small):
    import random

    from conftest import sentence

    rng = random.Random(12)
    a, b, c, d = (sentence(rng, 60) for _ in range(4))
    rows = [(1, a), (1, b), (1, b), (None, c), (None, d), (None, None), (4, a + " more"), (9, c), (3, ""), (3, None)]
    docs = make_docs(rows).select("doc_id", "text", "lang", "source", F.lit(7).cast("long").alias("n_chars"))
    kept = corpus_pipeline.keep_one_of_similar(shipped, docs, small)
    assert kept.columns == corpus_pipeline.COLUMNS
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter([(1, a), (1, b), (9, c), (None, d), (None, None), (3, ""), (3, None)])
    lines = corpus_pipeline.drop_repeated_lines(shipped, docs, small)
    assert sum(r.doc_id is None for r in lines.collect()) == 3
    quality = corpus_pipeline.keep_quality(shipped, docs, small)
    assert quality.columns == corpus_pipeline.COLUMNS


@pytest.mark.parametrize("name", sorted(corpus.ORACLE_SQL))
def test_queries_have_the_same_rows_as_sql(shipped, small, name):
    from compare import difference

    assert difference(corpus.QUERIES[name](shipped, small), corpus.ORACLE_SQL[name], small) is None
