"""Operators that look at one text at a time: quality, secrets, token counts, packing."""

from __future__ import annotations

import base64
import json
import random
import tracemalloc
import types
import zlib
from collections import defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest

from pulseframe.llm import packing, queries, secret_scan, token_counts
from pulseframe.llm.quality_gam import FEATURES, GamSettings, fit, quality_filter, quality_scores, text_features
from pulseframe.llm.token_ids import Encoder

public_tokenizers = pytest.importorskip("public_tokenizers")


# Quality.


def test_text_features_are_finite():
    import pyarrow as pa

    x = text_features(pa.array([None, "", " ", "a", "A\n\nb! | é", "w " * 5000]))
    assert x.shape == (6, len(FEATURES)) and np.isfinite(x).all()
    assert np.array_equal(x[0], x[1])


def test_model_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((4000, len(FEATURES)), np.float32)
    y = ((x[:, 2] > 0.5) ^ (x[:, 5] > 0.5)).astype(float)
    model = fit(x[:3000], y[:3000])
    assert (2, 5) in model.pairs
    assert ((model.scores(x[3000:]) > 0.5) == y[3000:]).mean() > 0.97


def test_quality_is_learnt(shipped, small):
    scored = queries.op2_quality_classifier(shipped, small)
    labels = shipped.read.parquet(f"{small}/labels.parquet")
    documents = shipped.read.parquet(f"{small}/documents.parquet")
    rows = scored.join(labels, "doc_id").toPandas()
    assert scored.count() == documents.count()
    assert rows["score"].between(0, 1).all()
    out = rows[rows["held_out"]]
    assert (out["predicted"] == out["quality"]).mean() > 0.9
    assert all(zlib.crc32(str(i).encode()) % 4 == 2 for i in out["doc_id"])


def test_held_out_labels_do_not_matter(make_docs, shipped, odd_rows):
    labels = [(i, i % 2) for i, _ in odd_rows]
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q) for i, q in labels]
    docs = make_docs(odd_rows + [(None, "x"), (7, None)])
    a, b = (quality_scores(docs, shipped.createDataFrame(x, "doc_id long, quality int")) for x in (labels, turned))
    assert labels != turned and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert a.count() == len(odd_rows) + 2


def test_quality_without_labels(make_docs, shipped, odd_rows):
    docs = make_docs(odd_rows)
    none = shipped.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality_scores(docs, none).collect()} == {0.5}
    assert quality_scores(make_docs([]), none).count() == 0
    one = shipped.createDataFrame([(i, 1) for i, _ in odd_rows] + [(3, None), (None, 0)], "doc_id long, quality int")
    assert len({r.score for r in quality_scores(docs, one).collect()}) == 1
    left = quality_filter(docs, one, GamSettings(most_rows=3))
    assert left.columns == docs.columns


# Secrets.


def der(tag, content):
    n = len(content)
    size = bytes([n]) if n < 128 else bytes([0x80 | (n.bit_length() + 7) // 8]) + n.to_bytes((n.bit_length() + 7) // 8, "big")
    return bytes([tag]) + size + content


def fields(*parts):
    return b"".join(len(p).to_bytes(4, "big") + p for p in parts)


def url64(data):
    return base64.urlsafe_b64encode(data).decode().rstrip("=")


@pytest.fixture(scope="module")
def made_up():
    """Structures with random content; none is a real secret."""
    rng = random.Random(9)
    numbers = [der(0x02, b"\1" + rng.randbytes(63)) for _ in range(4)]
    key = der(0x30, der(0x02, b"\0") + b"".join(numbers))
    blob = fields(b"ssh-" + b"ed25519", rng.randbytes(32))
    token = url64(json.dumps({"alg": "none"}).encode()) + "." + url64(b'{"sub":"x"}') + "." + url64(rng.randbytes(32))
    return {"key": key, "blob": blob, "token": token}


def kinds(text):
    return {s[0] for s in secret_scan.spans_of(text)}


def test_confirmed_structures(made_up):
    key = base64.b64encode(made_up["key"]).decode()
    assert "der_key" in kinds(f"see {key} there")
    assert "der_key" in kinds(made_up["key"].hex())
    # A public key is no secret.
    assert "key_blob" not in kinds(base64.b64encode(made_up["blob"]).decode() + " me@host")
    assert "signed_token" in kinds(f"Bearer {made_up['token']} end")
    lines = "\n".join(key[k : k + 64] for k in range(0, len(key), 64))
    assert "pem_key" in kinds(f"-----BEGIN RSA PRIVATE KEY-----\n{lines}\n-----END RSA PRIVATE KEY-----")


def test_broken_structures(made_up):
    cut = made_up["key"][:-1]
    assert kinds(base64.b64encode(cut).decode()) <= {"hex"}
    assert not secret_scan.is_der_key(der(0x30, b"\x02\x00" * 20))
    assert kinds(url64(b"no json at all here") + ".abcd.efgh") == set()
    assert kinds(base64.b64encode(bytes(range(200, 256)) * 2).decode()) == set()
    assert kinds("a" * 100_000) <= {"hex"}


SECRETS = [
    (1, 'Password: "hunter2hunter" and token=abc and API_KEY = xyz123/+='),
    (2, "AKIA" + "Q" * 16 + " AKIA" + "Q" * 15 + " é" * 30 + "0123456789abcdef01234567 0123456789ABCDEF01234567"),
    (3, None),
    (4, ""),
    (5, "ſecret=abcdefgh toKen=abcdefgh seCRet'=  'abcdefgh passKey"),
    (6, "token=" * 40 + "abcdef"),
    (6, "token=" * 40 + "abcdef"),
    (None, "secret=abcdefg"),
    (7, "😀 passwd:'123456' 😀 " + "f" * 24),
]


def test_base_secrets(make_docs, odd_rows):
    rows = odd_rows + SECRETS
    found = secret_scan.digest(secret_scan.secret_scan(make_docs(rows))).collect()
    mine = sorted((str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in found)
    assert mine == sorted((str(i), *brute.base_secrets(t)) for i, t in rows)
    assert sum(r.n_assign for r in found) >= 6
    assert secret_scan.secret_scan(make_docs([])).count() == 0


# Token counts.


def best_count(word, pieces, byte):
    longest = max(map(len, pieces))
    best = [(0.0, 0)]
    for j in range(1, len(word) + 1):
        offers = [(best[i][0] + pieces[word[i:j]], best[i][1] - 1) for i in range(max(0, j - longest), j) if word[i:j] in pieces]
        if word[j - 1] not in pieces:
            n = len(word[j - 1].encode())
            offers.append((best[j - 1][0] + n * byte, best[j - 1][1] - n))
        best.append(max(offers))
    return -best[-1][1]


def test_token_counts(make_docs, odd_rows):
    rows = odd_rows + SECRETS + [(300, "漢字 " + "z" * 3000 + " 😀😀")]
    pieces = token_counts.vocabulary()
    byte = min(pieces.values()) - token_counts.BYTE_PENALTY
    expected = []
    for i, t in rows:
        words = brute.WHITE_WORDS.findall(t or "")
        expected.append((str(i), len(words), sum(best_count(token_counts.SPACE + w, pieces, byte) for w in words)))
    found = token_counts.token_counts(make_docs(rows)).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_tokens) for r in found) == sorted(expected)
    assert token_counts.token_counts(make_docs([])).count() == 0


def test_counter_starts_anew(monkeypatch):
    monkeypatch.setattr(token_counts, "MOST_WORDS", 3)
    counter = token_counts.Counter({"a": -1.0, "ab": -1.5, token_counts.SPACE: -3.0, token_counts.SPACE + "a": -2.0})
    assert counter.totals([b"ab ab a", b"b"]) == counter.totals([b"ab ab a", b"b"]) == [(3, 5), (1, 2)]


@pytest.mark.parametrize("deepest", [0, 1, 3, 256])
def test_long_words_that_begin_alike(monkeypatch, deepest):
    monkeypatch.setattr(token_counts, "DEEPEST", deepest)
    pieces = {"a": -1.0, "b": -1.25, "ab": -1.5, "aba": -1.75, "bab": -2.5, "ca": -3.0, token_counts.SPACE: -3.0, token_counts.SPACE + "a": -2.0}
    rng = random.Random(deepest)
    stems = ["".join(rng.choice("abcé") for _ in range(n)) for n in (2, 5, 300)]
    words = sorted({token_counts.SPACE + rng.choice(stems) + "".join(rng.choice("abc") for _ in range(rng.randrange(6))) for _ in range(80)})
    counter = token_counts.Counter(pieces)
    assert counter.counts(words) == [best_count(w, pieces, counter.byte) for w in words]


def test_a_long_word_takes_little_memory():
    counter = token_counts.Counter({"a": -1.0, "ab": -1.5, "aba": -1.75, "b": -1.0, token_counts.SPACE: -3.0})
    words = [token_counts.SPACE + "ab" * 50_000, token_counts.SPACE + "ab" * 50_000 + "a"]
    tracemalloc.start()
    counter.counts(words)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 1 << 20


# Packing.


def test_open_sequences():
    rng = random.Random(2)
    bins, used, last = packing.OpenSequences(100, 8), defaultdict(int), {}
    for _ in range(3000):
        length = rng.randrange(1, 101)
        name, offset = bins.place(length)
        assert offset == used[name] and offset + length <= 100
        used[name] += length
        assert bins.count <= 8
        last[name] = True
    assert set(bins.open_names()) <= set(used)
    bins = packing.OpenSequences(10, 2)
    assert [bins.place(n) for n in (6, 5, 4, 5)] == [(0, 0), (1, 0), (0, 6), (1, 5)]
    bins = packing.OpenSequences(10, 2)
    assert [bins.place(n)[0] for n in (6, 7, 8, 4, 2)] == [0, 1, 2, 0, 2]  # the fullest, 1, closed for 2


def test_closed_sequences_are_named_once():
    rng = random.Random(3)
    bins, met, closed = packing.OpenSequences(50, 4), set(), []
    for _ in range(2000):
        name, _ = bins.place(rng.randrange(1, 51))
        assert name not in closed[:-1] and (name not in closed)
        met.add(name)
        closed += bins.closed
        bins.closed.clear()
    assert len(closed) == len(set(closed)) and set(closed) | bins.open_names() == met and not set(closed) & bins.open_names()


def test_pieces_leave_when_their_sequence_closes(monkeypatch):
    """No batch, and nothing that waits, grows with the task."""
    monkeypatch.setattr(packing, "ROWS_AT_ONCE", 50)
    monkeypatch.setattr(packing, "BATCH_CHARS", 2000)
    monkeypatch.setattr(packing.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 3})())
    rng = random.Random(6)
    texts = [" ".join(f"word{rng.randrange(99)}" for _ in range(rng.randrange(30))) for _ in range(3000)]
    read = []

    def parts():
        for at in range(0, len(texts), 100):
            read.append(at)
            yield pa.RecordBatch.from_pydict({"doc_id": list(range(at, at + 100)), "text": texts[at : at + 100]})

    out, early = [], 0
    for batch in packing._pack(parts(), None, 64, 2, 8):
        early += len(batch) > 0 and len(read) < len(texts) // 100
        assert len(batch) <= 50 + 64
        out += [types.SimpleNamespace(**r) for r in batch.to_pylist()]
    assert early > 20
    check_packing(list(enumerate(texts)), out, 64)
    assert len({r.sequence_id for r in out if r.open}) <= 8 and len({(r.sequence_id, r.open) for r in out}) == len({r.sequence_id for r in out})


def test_cuts():
    assert packing.cuts(5, 4) == [(0, 1), (1, 4)]
    assert packing.cuts(8, 4) == [(0, 4), (4, 4)]
    assert packing.cuts(4, 4) == [(0, 4)] and packing.cuts(1, 4) == [(0, 1)]


def check_packing(rows, packed, size=1024):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = defaultdict(int)
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        for piece, (start, length) in enumerate(packing.cuts(len(ids), size)):
            expected[i, piece, start, length, zlib.crc32(ids[start : start + length].tobytes())] += 1
    found, places = defaultdict(int), defaultdict(list)
    for r in packed:
        found[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        places[r.sequence_id].append((r.offset, r.length))
    assert found == expected
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(places)


TEXTS = [
    (1, None),
    (2, ""),
    (3, "two  spaces and\ttab \n\n new line  "),
    (4, "<|endoftext|> inside <|endoftext|>x"),
    (5, "it's we'll hard break 123abc \r\n"),
    (6, "x" * 5000),
    (7, "plain words only"),
    (None, "plain words only"),
    (7, "plain words only"),
    (8, "漢字 😀 é\x1c x"),
]


@pytest.mark.parametrize("size", [1024, 16])
def test_pack(make_docs, odd_rows, size):
    rows = odd_rows + TEXTS
    packed = packing.pack(make_docs(rows).repartition(5), size=size).collect()
    n = check_packing(rows, packed, size)
    assert n <= 1.1 * sum(r.length for r in packed) / size + 2
    assert packing.pack(make_docs([])).count() == 0


def test_encoder_starts_anew(monkeypatch):
    from pulseframe.llm import token_ids

    monkeypatch.setattr(token_ids, "MOST_WORDS", 2)
    path = public_tokenizers.path("byte_bpe_50k.json")
    ranked = Encoder(path, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    texts = [t or "" for _, t in TEXTS]
    for encoder in (Encoder(path), ranked):
        assert encoder.batch(texts) == encoder.batch(texts) == [b"".join(encoder._encode([t])) for t in texts]
