"""Phrase mining, against plain counts."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from brute import FOLD

from pulseframe.llm import phrase_mining as mining

SCHEMA = "doc_id long, text string, lang string, chunk int, bucket string, size string, f int, tags map<string,string>"
PIECES, WORDS = re.compile(r"[.,;:!?\x0A-\x0D]"), re.compile(r"[^\x20\x09]+")


def plain(rows, longest=3, least=10, share=50, most=2000):
    f, n = {}, Counter()
    for text, lang in rows:
        mine = f.setdefault(lang or "und", Counter())
        for piece in PIECES.split((text or "").translate(FOLD)):
            w = WORDS.findall(piece)
            n[lang or "und"] += len(w)
            for size in range(1, longest + 1):
                mine.update(tuple(w[s : s + size]) for s in range(len(w) - size + 1))
    out = []
    for lang, counts in f.items():
        frequent = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        gone = {
            p[s : s + size]
            for p, b in frequent.items()
            for size in range(2, len(p))
            for s in range(len(p) - size + 1)
            if 100 * b >= share * counts[p[s : s + size]]
        }
        scored = []
        for p, a in frequent.items():
            score, k, left, right = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            if p not in gone:
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(scored)[:most])]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(k if k % 9 else None, t, lang, k, "x", "y", 1, {"a": "b"}) for k, (t, lang) in enumerate(rows)], SCHEMA)


def run(spark, rows, **settings):
    found = mining.phrase_mining(table(spark, rows), **settings)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, found.collect()))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(21)
    words = "the of and Ünï tok über x1 y-2 z's".split()
    rows = []
    for k in range(260):
        parts = []
        for _ in range(rng.randrange(0, 40)):
            parts.append(rng.choice(words))
            parts.append(rng.choice([" ", " ", " ", "  ", "\t", ", ", ". ", "\n", " ! "]))
        if k % 3 == 0:
            parts.append("new york city new york city hall")
        rows.append(("".join(parts), rng.choice(["en", "en", "de", None, "und"])))
    rows += [(None, "en"), ("", "fr"), ("...", "fr"), ("a b", "fr"), ("The the THE the the " * 30, "en"), ("w " * 4000 + "." + "w w w", "long")]
    rows += [("same copy of one text", "en")] * 40
    return rows


@pytest.mark.parametrize("shard", [4 << 20, 2000])
def test_phrases(shipped, texts, monkeypatch, shard):
    monkeypatch.setattr(mining, "SHARD_BYTES", shard)
    assert run(shipped, texts) == plain(texts)


@pytest.mark.parametrize("longest, least, share, most", [(2, 5, 50, 2000), (4, 3, 80, 2000), (5, 12, 30, 7)])
def test_other_sizes(shipped, texts, monkeypatch, longest, least, share, most):
    monkeypatch.setattr(mining, "SHARD_BYTES", 4000)
    assert run(shipped, texts, most_words=longest, least=least, share=share, most=most) == plain(texts, longest, least, share, most)


def test_no_candidates_and_empty_tables(shipped):
    assert run(shipped, []) == []
    assert run(shipped, [("a b c", "en"), (None, None)]) == []
    with pytest.raises(ValueError):
        run(shipped, [], least=16)


def test_a_long_text_without_spaces(shipped):
    rows = [("y" * 2_000_000, "en"), ("a b " * 300_000, "en")]
    assert run(shipped, rows) == plain(rows)


def test_products_beyond_64_bits(shipped):
    counts = shipped.createDataFrame([("en", 1, "a", 9 * 10**13), ("en", 1, "b", 8 * 10**13), ("en", 2, "a b", 7 * 10**13)], mining.COUNTS)
    assert [r["score"] for r in mining._cut_scores(counts, 3).collect()] == [1000000 * 49 // 72]


@pytest.mark.parametrize("kinds", [7, 3_000_000])
def test_intervals_of_both_directions(kinds):
    """Left and right extensions agree with each other and with plain counts."""
    rng = np.random.default_rng(2)
    numbers = rng.integers(1, 7, 400) if kinds == 7 else rng.choice([1, 5, 2_900_000], 400)
    sequence = np.where(rng.random(400) < 0.1, 0, numbers)
    sequence[0] = 0
    index = mining.PhraseIndex(sequence, kinds, 3)
    single = index.single()
    single = single.of(single.count > 0)
    seen = Counter(tuple(sequence[s : s + 3]) for s in range(398) if 0 not in sequence[s : s + 3])
    for grown in (
        index.extended_left(index.extended_right(single)),
        index.extended_right(index.extended_left(single)),
        index.extended_right(index.extended_right(single)),
        index.extended_left(index.extended_left(single)),
    ):
        assert dict(zip(map(tuple, grown.words.tolist()), grown.count.tolist())) == {tuple(map(int, k)): v for k, v in seen.items()}
