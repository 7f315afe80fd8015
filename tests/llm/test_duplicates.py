"""Operators that find what documents share, against plain versions."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from conftest import sentence
from pyspark.sql import functions as F

from pulseframe.llm import exchange, line_dedup, ngram_join
from pulseframe.llm.components import components
from pulseframe.llm.rolling import Texts, Words
from pulseframe.llm.substring_dedup import COVERS, period_for, substring_dedup
from pulseframe.llm.suffix_dedup import suffix_dedup

REPEATED = [(3, "again " * 60), (3, "again " * 60), (None, "again " * 60)]


def words_result(df):
    rows = df.select("doc_id", "n_words", "n_removed", "kept").collect()
    return sorted((r.doc_id, r.n_words, r.n_removed, brute.sha(r.kept.encode())) for r in rows)


def words_expected(rows, window=50):
    return sorted((i, n, gone, brute.sha(" ".join(kept).encode())) for i, n, gone, kept in brute.without_windows(rows, window, brute.WHITE_WORDS.findall))


def bytes_result(df):
    rows = df.select("doc_id", "n_bytes", "n_removed", "kept").collect()
    return sorted((r.doc_id, r.n_bytes, r.n_removed, brute.sha(bytes(r.kept))) for r in rows)


def bytes_expected(rows, window=50):
    return sorted((i, n, gone, brute.sha(bytes(kept))) for i, n, gone, kept in brute.without_windows(rows, window, lambda t: t.encode()))


def test_covers_have_every_difference():
    for period, cover in COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    assert [period_for(n) for n in (1, 2, 8, 20, 50)] == [1, 1, 7, 13, 31]


@pytest.mark.parametrize("window", [50, 12, 1])
def test_substring_dedup(make_docs, odd_rows, window):
    rows = odd_rows + REPEATED
    assert words_result(substring_dedup(make_docs(rows), window)) == words_expected(rows, window)


@pytest.mark.parametrize("window", [50, 9])
def test_suffix_dedup(make_docs, odd_rows, window):
    rows = odd_rows + REPEATED
    assert bytes_result(suffix_dedup(make_docs(rows), window)) == bytes_expected(rows, window)


def test_windows_of_periodic_texts(make_docs):
    rng = random.Random(3)
    rows = [(k, "".join(rng.choice("ab") * rng.randrange(1, 9) + " " * rng.randrange(2) for _ in range(rng.randrange(60)))) for k in range(40)]
    assert words_result(substring_dedup(make_docs(rows), 3)) == words_expected(rows, 3)
    assert bytes_result(suffix_dedup(make_docs(rows), 7)) == bytes_expected(rows, 7)


def test_many_chunks_give_the_same(make_docs, odd_rows, monkeypatch):
    wide = exchange.Layout(13, 5)
    monkeypatch.setattr(exchange, "layout", lambda *a, **b: wide)
    docs = make_docs(odd_rows)
    assert words_result(substring_dedup(docs)) == words_expected(odd_rows)
    assert bytes_result(suffix_dedup(docs)) == bytes_expected(odd_rows)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_join(docs).collect()}
    assert found == brute.similar(odd_rows)
    done = line_dedup.line_dedup(docs, every=False).collect()
    assert sorted((r.doc_id, r.n_lines, r.n_removed) for r in done) == sorted(brute.removed_lines(odd_rows, line_dedup.aligned_blocks))


def test_ngram_join(make_docs, odd_rows):
    found = ngram_join.ngram_join(make_docs(odd_rows)).collect()
    assert len(found) == len(odd_rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute.similar(odd_rows)


def test_ngram_join_repeats_and_missing_ids(make_docs):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (5, "other words that stand here alone"), (9, "A B C D E F"), (None, "a b c d e f"), (2, None)]
    found = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.ngram_join(make_docs(rows)).collect())
    assert found == [(2, 0, 2), (5, 2, 5), (5, 2, 5), (5, 2, 5), (9, 2, 5)]


def near_families(seed, families=6, members=25):
    """Families whose members drift, so that links chain and thresholds are met closely."""
    rng = random.Random(seed)
    rows, name = [], 0
    for _ in range(families):
        words = sentence(rng, rng.randrange(8, 90)).split()
        for _ in range(members):
            words = list(words)
            for _ in range(rng.randrange(3)):
                words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
            rows.append((name, " ".join(words)))
            name += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join_of_drifting_families(make_docs, seed, monkeypatch):
    monkeypatch.setattr(ngram_join, "GROUP_SIZE", 4)
    monkeypatch.setattr(ngram_join, "QUERIES_AT_ONCE", 3)
    monkeypatch.setattr(ngram_join, "SET_BUCKET_BYTES", 1 << 12 if seed == 2 else 1 << 26)
    rows = near_families(seed)
    found = ngram_join.ngram_join(make_docs(rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute.similar(rows)


def test_components_of_a_chain(shipped):
    links = [(k, k + 1) for k in range(40)] + [(100, 99), (99, 100), (7, 7)]
    found = {r.id: r.component for r in components(shipped.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(41)}, 99: 99, 100: 99}


def test_line_dedup(make_docs, odd_rows):
    rows = odd_rows + REPEATED
    done = line_dedup.line_dedup(make_docs(rows), carry=["lang", "chunk"], every=False).collect()
    assert sorted((r.doc_id, r.n_lines, r.n_removed) for r in done) == sorted(brute.removed_lines(rows, line_dedup.aligned_blocks))
    texts = dict(odd_rows)
    for r in done:
        assert r.rest.lang == f"lang{r.doc_id}" and r.rest.chunk == f"chunk{r.doc_id}"
        if not r.n_removed and r.doc_id != 3:
            assert r.kept == (texts[r.doc_id] or "")
    assert any(0 < r.n_removed < r.n_lines for r in done) and any(r.n_removed == r.n_lines > 0 for r in done)


def test_patience_keeps_order_and_equality():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(9) for _ in range(rng.randrange(12))] for _ in range(2))
        pairs = line_dedup.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    assert line_dedup.patience("abcde", "xbcdy") == [(1, 1), (2, 2), (3, 3)]
    assert len(line_dedup.patience(list(range(50)), list(range(50)))) == 50


@pytest.mark.parametrize("operator", [substring_dedup, suffix_dedup, ngram_join.ngram_join, line_dedup.line_dedup])
def test_empty_and_blank_tables(make_docs, operator):
    assert operator(make_docs([])).count() == 0
    blank = [(1, None), (2, ""), (3, " "), (None, "x")]
    assert operator(make_docs(blank)).count() == 3


def test_words_at_text_edges():
    import pyarrow as pa

    words = Words(Texts(pa.array(["a b", None, "", "c", " d", "e "])))
    assert words.count.tolist() == [2, 0, 0, 1, 1, 1]
    assert np.array_equal(words.hashes[1:2], Words(Texts(pa.array(["b"]))).hashes)


def test_results_do_not_depend_on_partitions(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    one, many = (substring_dedup(docs.repartition(n, F.rand(1))) for n in (1, 7))
    assert words_result(one) == words_result(many)
