"""Text quality by a generalised additive model with pairwise interactions.

Features are cut into bins. The score's log-odds are a sum of one lookup table per feature and one
per chosen pair of features. Training goes round the features again and again and adds to each table
a shallow tree fitted to what the sum so far leaves over; then it does the same for the pairs whose
tables promise most. Scoring is one vectorised addition per table.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulseframe.llm.rolling import Texts, Windows, Words, positions


def _class(*parts) -> np.ndarray:
    row = np.zeros(256)
    for part in parts:
        row[[part] if isinstance(part, int) else list(part)] = 1
    return row


#: Byte classes whose shares of a text are features.
CLASSES = {
    "upper": _class(range(65, 91)),
    "lower": _class(range(97, 123)),
    "digits": _class(range(48, 58)),
    "beyond_ascii": _class(range(128, 256)),
    "white": _class(32, range(9, 14)),
    "line_feeds": _class(10),
    "stops": _class(*map(ord, ".?!")),
    "exclamations": _class(ord("!")),
    "commas": _class(*map(ord, ",;:")),
    "quotes": _class(*map(ord, "\"'()")),
    "symbols": _class(*map(ord, "#$%&*+/<=>@\\^_`{|}~[]-")),
    "bars": _class(ord("|")),
    "controls": _class(range(0, 9), range(14, 32), 127),
}
FEATURES = ["log_bytes", *CLASSES, "word_bytes", "words_per_line", "distinct_words", "distinct_trigrams", "symbol_words", "stop_words", "capital_words"]

ROWS = "doc_id long, label int, features array<float>"

#: Texts whose features are computed at a time, in rows.
ROWS_AT_ONCE = 200


def _distinct_share(keys: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    total = np.bincount(owner, minlength=n)
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    fresh = np.concatenate([[True], (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])])[: len(keys)]
    return np.bincount(owner[fresh], minlength=n) / np.maximum(total, 1)


def text_features(column: pa.Array) -> np.ndarray:
    """A row of FEATURES for every text; a null counts as an empty text."""
    texts = Texts(column)
    n = texts.n
    sizes = np.diff(texts.bounds)
    owner = np.repeat(np.arange(n), sizes)
    counts = np.bincount(owner * 256 + texts.data, minlength=256 * n).reshape(n, 256).astype(float)
    shares = counts @ np.stack(list(CLASSES.values()), 1) / np.maximum(sizes, 1)[:, None]
    words = Words(texts)
    of = np.repeat(np.arange(n), words.count)
    many = np.maximum(words.count, 1)
    last = texts.data[words.end - 1] if len(words.end) else np.empty(0, np.uint8)
    first = texts.data[words.start] if len(words.start) else np.empty(0, np.uint8)
    share = lambda row, at: np.bincount(of, row[at], minlength=n) / many if len(at) else np.zeros(n)
    start, text = positions(words.bounds, 3)
    return np.column_stack(
        [
            np.log1p(sizes),
            shares,
            np.bincount(of, words.end - words.start, minlength=n) / many,
            words.count / (counts[:, 10] + 1),
            _distinct_share(words.hashes, of, n),
            _distinct_share(Windows(words.hashes).of(start, start + 3), text, n),
            share(CLASSES["symbols"] + CLASSES["exclamations"], last),
            share(CLASSES["stops"], last),
            share(CLASSES["upper"], first),
        ]
    ).astype(np.float32)


@dataclass(frozen=True)
class GamSettings:
    """`most_rows` bounds the labelled rows used to fit; they are chosen by a hash of their id."""

    most_rows: int = 20_000
    bins: int = 48
    rounds: int = 120
    pair_rounds: int = 40
    pairs: int = 8
    rate: float = 0.1
    smallest_leaf: int = 5
    ridge: float = 2.0


@dataclass(frozen=True)
class Gam:
    edges: list[np.ndarray]
    base: float
    tables: np.ndarray  # features by bins
    pairs: list[tuple[int, int]]
    pair_tables: np.ndarray  # pairs by bins by bins

    @property
    def tells_apart(self) -> bool:
        """Whether any feature makes a difference; not so where rows of both labels were lacking."""
        return bool(self.tables.any() or self.pair_tables.any())

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)])

    def log_odds(self, binned: np.ndarray) -> np.ndarray:
        total = np.full(len(binned), self.base)
        for j, table in enumerate(self.tables):
            total += table[binned[:, j]]
        for (j, k), table in zip(self.pairs, self.pair_tables):
            total += table[binned[:, j], binned[:, k]]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.log_odds(self.binned(x))))


def _split(gradient: np.ndarray, weight: np.ndarray, count: np.ndarray, s: GamSettings) -> tuple[float, int]:
    """The best cut of a row of bins: what it gains, and its first bin on the right."""
    g, h, n = np.cumsum(gradient)[:-1], np.cumsum(weight)[:-1], np.cumsum(count)[:-1]
    gt, ht, nt = gradient.sum(), weight.sum(), count.sum()
    gain = g**2 / (h + s.ridge) + (gt - g) ** 2 / (ht - h + s.ridge) - gt**2 / (ht + s.ridge)
    gain[(n < s.smallest_leaf) | (nt - n < s.smallest_leaf)] = -1
    at = int(np.argmax(gain)) if len(gain) else 0
    return (float(gain[at]), at + 1) if len(gain) else (-1.0, 0)


def _tree(gradient: np.ndarray, weight: np.ndarray, count: np.ndarray, s: GamSettings) -> np.ndarray:
    """A tree of depth two over the bins: its value in each."""
    value = np.zeros(len(gradient))

    def grow(lo: int, hi: int, depth: int) -> None:
        if depth:
            gain, at = _split(gradient[lo:hi], weight[lo:hi], count[lo:hi], s)
            if gain > 0:
                grow(lo, lo + at, depth - 1)
                grow(lo + at, hi, depth - 1)
                return
        value[lo:hi] = gradient[lo:hi].sum() / (weight[lo:hi].sum() + s.ridge)

    grow(0, len(gradient), 2)
    return value


def _pair_tree(gradient: np.ndarray, weight: np.ndarray, count: np.ndarray, s: GamSettings) -> tuple[float, np.ndarray]:
    """The best tree that cuts one feature and then, on each side, the other; and what it gains."""
    root = gradient.sum() ** 2 / (weight.sum() + s.ridge)
    best = (0.0, np.zeros_like(gradient))
    for turned in (False, True):
        g, h, n = (np.pad(x.T if turned else x, ((1, 0), (1, 0))).cumsum(0).cumsum(1) for x in (gradient, weight, count))
        sides = []
        for gs, hs, ns in ((g, h, n), (g[-1] - g, h[-1] - h, n[-1] - n)):  # rows below and from each first cut
            value = lambda a, b: a**2 / (b + s.ridge)
            gain = value(gs, hs) + value(gs[:, -1:] - gs, hs[:, -1:] - hs)
            small = (np.minimum(ns, ns[:, -1:] - ns) < s.smallest_leaf) & (np.arange(gs.shape[1]) > 0)
            gain[small] = -1
            sides.append((gain.max(1), gain.argmax(1), gs, hs))
        total = sides[0][0] + sides[1][0] - root
        at = int(np.argmax(total))
        if total[at] > best[0]:
            table = np.zeros_like(gradient.T if turned else gradient)
            for (_, cuts, gs, hs), rows in zip(sides, (slice(0, at), slice(at, None))):
                cut = int(cuts[at])
                left, mass = gs[at, cut], hs[at, cut]
                table[rows, :cut] = left / (mass + s.ridge)
                table[rows, cut:] = (gs[at, -1] - left) / (hs[at, -1] - mass + s.ridge)
            best = (float(total[at]), table.T if turned else table)
    return best


def fit(x: np.ndarray, y: np.ndarray, settings: GamSettings = GamSettings()) -> Gam:
    """A model of the labelled rows; with one label only, or none, it knows their smoothed share alone."""
    s = settings
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, s.bins + 1)[1:-1])) if len(x) else np.empty(0) for j in range(len(FEATURES))]
    tables = np.zeros((len(edges), s.bins))
    model = Gam(edges, base, tables, [], np.zeros((0, s.bins, s.bins)))
    if len(np.unique(y)) < 2:
        return model
    b = model.binned(x)
    total = np.full(len(y), base)

    def left_over() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    counts = [np.bincount(b[:, j], minlength=s.bins) for j in range(len(edges))]
    for _ in range(s.rounds):
        for j in range(len(edges)):
            g, h = left_over()
            step = s.rate * _tree(np.bincount(b[:, j], g, s.bins), np.bincount(b[:, j], h, s.bins), counts[j], s)
            tables[j] += step
            total += step[b[:, j]]

    def cells(j: int, k: int, weights=None) -> np.ndarray:
        return np.bincount(b[:, j] * s.bins + b[:, k], weights, s.bins**2).reshape(s.bins, s.bins)

    g, h = left_over()
    promise = [(_pair_tree(cells(j, k, g), cells(j, k, h), cells(j, k), s)[0], j, k) for j, k in itertools.combinations(range(len(edges)), 2)]
    pairs = [(j, k) for gain, j, k in sorted(promise, key=lambda t: (-t[0], t[1:]))[: s.pairs] if gain > 0]
    pair_tables = np.zeros((len(pairs), s.bins, s.bins))
    pair_counts = [cells(j, k) for j, k in pairs]
    for _ in range(s.pair_rounds):
        for at, (j, k) in enumerate(pairs):
            g, h = left_over()
            step = s.rate * _pair_tree(cells(j, k, g), cells(j, k, h), pair_counts[at], s)[1]
            pair_tables[at] += step
            total += step[b[:, j], b[:, k]]
    return Gam(edges, base, tables, pairs, pair_tables)


def held_out(doc_id):
    """Rows that never train: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _labelled(labels: DataFrame, label: str) -> DataFrame:
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    return known.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).distinct()


def fit_quality(
    docs: DataFrame, labels: DataFrame, settings: GamSettings = GamSettings(), id_column: str = "doc_id", text: str = "text", label: str = "quality"
) -> Gam:
    """A model of the labelled documents that are not held out, of up to about `most_rows` of them.

    Beyond that number the ids whose hash is low enough train. Only the features of these rows come to
    the driver, so both it and the broadcast of their ids are bounded by the setting.
    """
    known = _labelled(labels, label)
    share = min(1.0, settings.most_rows / max(known.count(), 1))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def rows_of(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            x = text_features(part.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), lists], names=["doc_id", "label", "features"])

    rows = source.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text").mapInArrow(rows_of, ROWS).collect()
    rows = sorted((r["doc_id"], r["label"], tuple(r["features"])) for r in rows)
    x = np.array([r[2] for r in rows], np.float32).reshape(len(rows), len(FEATURES))
    return fit(x, np.array([r[1] for r in rows], float), settings)


def with_quality(docs: DataFrame, model: Gam, text: str = "text") -> DataFrame:
    """(row, score): every row of the documents as it is, and its score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = part.column("row")
            texts = rows.field(at_text).cast(pa.string())
            scores = [sent.value.scores(text_features(texts.slice(at, ROWS_AT_ONCE))) for at in range(0, len(part), ROWS_AT_ONCE)]
            yield pa.RecordBatch.from_arrays([rows, pa.array(np.concatenate([*scores, np.empty(0)]))], names=["row", "score"])
            pa.default_memory_pool().release_unused()

    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    at_text = docs.columns.index(text)
    schema = T.StructType([rows.schema["row"], T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(score, schema)


def quality_scores(
    docs: DataFrame, labels: DataFrame, settings: GamSettings = GamSettings(), threshold: float = 0.7, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, held_out, score, predicted for every document, from its text alone.

    Labels (doc_id, quality) train; rows that are held out, without an id or with another label than 0
    and 1 do not. An id with both labels trains as two rows. A null text is scored as an empty one.
    Every row is scored, rows without an id and rows that share one too. Without labels all scores
    are 0.5; with one label only they are all its smoothed share. Other columns are ignored.
    """
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    scored = with_quality(source, fit_quality(source, labels, settings))
    doc_id = F.col("row.doc_id")
    return scored.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def quality_filter(
    docs: DataFrame, labels: DataFrame, settings: GamSettings = GamSettings(), threshold: float = 0.7, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of the documents whose score reaches the threshold, with all their columns.

    A null text is scored as an empty one. Rows without an id, and rows that share one, are judged by their texts; very long texts
    are scored whole. Where the labels that may train are not of both kinds the model cannot tell texts apart, and all rows stay. An
    empty table stays empty.
    """
    model = fit_quality(docs, labels, settings, id_column, text)
    if not model.tells_apart:
        return docs
    scored = with_quality(docs, model, text)
    return scored.where(F.col("score") >= threshold).select("row.*")
