"""Collocations of every language from word n-grams that sharded FM-indexes enumerate.

Documents are dealt into shards. A shard numbers its words and indexes the sequence of numbers: its
suffixes in the order of their first few words, the word before each (the Burrows-Wheeler transform),
and the same for the sequence read backwards. A phrase is an interval of both orders, whose width is its count.
One step finds all phrases that begin with it, or end in it, and are one word longer.

A phrase can be frequent only if both phrases that are one word shorter are. So the shards ask, size by
size, which of their phrases are frequent in all shards together, and extend only these. At the end they report
the counts of what is left, and the counts are summed.
"""

from __future__ import annotations

from contextlib import ExitStack
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulseframe.llm import exchange
from pulseframe.llm.rolling import BASE, BYTE_VALUES, Texts, Windows, mix
from pulseframe.llm.spans import Spans, byte_set
from pulseframe.staging import stage, staged

#: Bytes that end a piece of text, and those that only part words.
ENDS = byte_set(*b".,;:!?", range(0x0A, 0x0E))
GAPS = ENDS | byte_set(0x20, 0x09)

SHARD_BYTES = 4 << 20
BUCKET_BYTES = 4 << 20
#: What stands for a language that is not given.
UNKNOWN = "und"
#: Parts of a language whose best phrases are found before they meet.
MERGE_PARTS = 64

COUNTS = "lang string, size int, phrase string, f long"


@dataclass(frozen=True)
class Phrases:
    """Phrases of one size in a shard: word numbers, and the intervals in both orders."""

    words: np.ndarray  # (phrases, size)
    low: np.ndarray
    back: np.ndarray
    count: np.ndarray

    def of(self, chosen: np.ndarray) -> Phrases:
        return Phrases(self.words[chosen], self.low[chosen], self.back[chosen], self.count[chosen])


class _Order:
    """One direction: suffixes by their first `depth` numbers, and the number before each."""

    def __init__(self, sequence: np.ndarray, kinds: int, depth: int):
        following = [np.roll(sequence, -i) for i in range(depth)]
        bits = max(1, int(kinds).bit_length())
        if bits * depth < 64:
            packed = np.zeros(len(sequence), np.uint64)
            for part in following:
                packed = packed << np.uint64(bits) | part.astype(np.uint64)
            suffixes = np.argsort(packed)
        else:
            suffixes = np.lexsort(following[::-1])
        self.before = sequence[suffixes - 1].astype(np.int64)
        self.width = len(sequence) + 1
        self.places = np.sort(self.before * self.width + np.arange(len(sequence)))

    def step(self, number: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Where the suffixes begin that start with `number` followed by those from `place` on."""
        return np.searchsorted(self.places, number * self.width + place)


class PhraseIndex:
    """Both orders of a sequence of word numbers in which 0 parts what does not belong together."""

    def __init__(self, sequence: np.ndarray, kinds: int, depth: int):
        self.sequence, self.kinds, self.depth = sequence, kinds, depth
        self.first = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=kinds + 1))])

    @cached_property
    def forward(self) -> _Order:
        return _Order(self.sequence, self.kinds, self.depth)

    @cached_property
    def backward(self) -> _Order:
        return _Order(self.sequence[::-1], self.kinds, self.depth)

    def single(self) -> Phrases:
        """Every number; single ones lie at the same places in both orders."""
        low = self.first[1:-1]
        return Phrases(np.arange(1, self.kinds + 1)[:, None], low, low, self.first[2:] - low)

    def _extended(self, order: _Order, low: np.ndarray, other: np.ndarray, count: np.ndarray):
        """Every number before the given intervals of `order`: (phrase, number, low, other low, count)."""
        ends = np.cumsum(count)
        rows = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(low - (ends - count), count)
        pairs, n = np.unique(np.repeat(np.arange(len(low)), count) * (self.kinds + 1) + order.before[rows], return_counts=True)
        phrase, number = pairs // (self.kinds + 1), pairs % (self.kinds + 1)
        # In the other order a phrase's suffixes are sorted by the number that follows there.
        passed = np.cumsum(n) - n
        passed -= passed[np.searchsorted(phrase, phrase)] if len(phrase) else 0
        kept = number > 0
        phrase, number, n, passed = phrase[kept], number[kept], n[kept], passed[kept]
        return phrase, number, order.step(number, low[phrase]), other[phrase] + passed, n

    def extended_left(self, phrases: Phrases) -> Phrases:
        at, number, low, back, count = self._extended(self.forward, phrases.low, phrases.back, phrases.count)
        return Phrases(np.column_stack([number, phrases.words[at]]), low, back, count)

    def extended_right(self, phrases: Phrases) -> Phrases:
        at, number, back, low, count = self._extended(self.backward, phrases.back, phrases.low, phrases.count)
        return Phrases(np.column_stack([phrases.words[at], number]), low, back, count)


def _named(names: np.ndarray, words: np.ndarray) -> np.ndarray:
    """64-bit names of phrases from those of their words."""
    out = mix(names[words[:, 0]] + np.uint64(words.shape[1]))
    for column in words[:, 1:].T:
        out = mix(out * BASE + names[column])
    return out


class _Shard:
    """The words of a shard's rows, named by language and word."""

    def __init__(self, table: pa.Table, bits: int):
        self.spans = Spans(Texts(table.column("text")), GAPS, lower=True)
        langs = pc.fill_null(table.column("lang"), UNKNOWN)
        held = Texts(langs)
        of_lang = mix(Windows(BYTE_VALUES[held.data]).of(held.bounds[:-1], held.bounds[1:]))
        self.langs, self.owner = langs, self.spans.owner()
        self.bits = bits
        self.keys, self.place, self.counts = exchange.distinct(mix(self.spans.hashes() + of_lang[self.owner]), bits)

    def parted(self) -> np.ndarray:
        """Before which words a piece of text ends, or another text begins."""
        start, end = self.spans.start, self.spans.end
        passed = np.concatenate([[0], np.cumsum(ENDS[self.spans.data])])
        parted = np.ones(len(start), bool)
        parted[1:] = (passed[start[1:]] > passed[end[:-1]]) | (self.owner[1:] != self.owner[:-1])
        return parted

    def index(self, frequent: np.ndarray, depth: int) -> tuple[PhraseIndex, np.ndarray]:
        """The index of the frequent words, and the names of their numbers; other words part phrases."""
        number = np.where(frequent, np.cumsum(frequent), 0)
        parted = self.parted()
        sequence = np.zeros(len(self.place) + int(parted.sum()) + 1, np.int64)
        sequence[np.arange(len(self.place)) + np.cumsum(parted)] = number[self.place]
        return PhraseIndex(sequence, int(frequent.sum()), depth), np.concatenate([np.zeros(1, np.uint64), self.keys[frequent]])

    def frequent_phrases(self, answers: list[np.ndarray], depth: int, least: int) -> list[tuple[Phrases, np.ndarray]]:
        """Phrases size by size with their names: frequent ones of the sizes that are answered, then all of the next one, up to `depth`."""
        frequent = answers[0] >= least
        index, names = self.index(frequent, min(depth, len(answers) + 1))
        phrases = index.single()
        found = [(phrases, _named(names, phrases.words))]
        for size in range(2, min(depth, len(answers) + 1) + 1):
            phrases, known = found[-1]
            left = size % 2 == 1
            phrases = index.extended_left(phrases) if left else index.extended_right(phrases)
            # The shorter phrase at the other end must be frequent too.
            rest = _named(names, phrases.words[:, :-1] if left else phrases.words[:, 1:])
            phrases = phrases.of(np.isin(rest, known))
            own = _named(names, phrases.words)
            order = np.argsort(own)
            phrases, own = phrases.of(order), own[order]
            if size <= len(answers):
                kept = answers[size - 1] >= least
                phrases, own = phrases.of(kept), own[kept]
            found.append((phrases, own))
        return found

    def report(self, found: list[tuple[Phrases, np.ndarray]], frequent: np.ndarray) -> pa.Table:
        """Counts of the phrases, and of all words by language under size 0."""
        first = np.full(len(self.keys), len(self.place), np.int64)
        np.minimum.at(first, self.place, np.arange(len(self.place)))
        first = first[frequent]
        words, langs = self.spans.words(first), self.langs.take(pa.array(self.owner[first]))
        parts = []
        for phrases, _ in found:
            at = [pa.array(c - 1) for c in phrases.words.T]
            text = pc.binary_join_element_wise(*(words.take(a) for a in at), " ") if len(at) > 1 else words.take(at[0])
            parts.append([langs.take(at[0]), pa.array(np.full(len(phrases.low), len(at)), pa.int32()), text, pa.array(phrases.count, pa.int64())])
        named, which = np.unique(self.langs.to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
        total = np.bincount(which, weights=self.spans.count, minlength=len(named)).astype(np.int64)
        n = len(named)
        parts.append([pa.array(named.tolist(), pa.string()), pa.array([0] * n, pa.int32()), pa.array([""] * n, pa.string()), pa.array(total)])
        tables = [pa.table([c.cast(pa.string()) if i in (0, 2) else c for i, c in enumerate(p)], names=["lang", "size", "phrase", "f"]) for p in parts]
        return pa.concat_tables(tables)


def phrase_counts(docs: DataFrame, most_words: int, least: int, lang: str, text: str, id_column: str, scratch: ExitStack) -> DataFrame:
    """(lang, size, phrase, f) of every phrase of up to `most_words` words that occurs `least` times, and size 0: all words."""
    # Copies of a text have ids of their own, which spread them.
    row = F.xxhash64(*(c for c in (id_column, lang, text) if c in docs.columns))
    source = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), row.alias("row")
    )
    size = source.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    shards, bits = max(1, -(-size // SHARD_BYTES)), max(3, int(size // BUCKET_BYTES).bit_length())
    chunks = source.select(F.pmod("row", F.lit(shards)).cast("int").alias("chunk"), "lang", "text")

    def answers(replies: pa.Table, sizes: int) -> list[np.ndarray]:
        return [exchange.answers(exchange.question(replies, bits, n)) for n in range(sizes)]

    def ask_words(table: pa.Table) -> pa.Table:
        shard = _Shard(table, bits)
        return exchange.count_request(int(table.column("chunk")[0].as_py()), shard.keys, shard.counts, bits)

    def ask_phrases(sizes: int):
        def ask(table: pa.Table, replies: pa.Table) -> pa.Table:
            shard = _Shard(table, bits)
            phrases, names = shard.frequent_phrases(answers(replies, sizes), most_words, least)[-1]
            return exchange.count_request(int(table.column("chunk")[0].as_py()), names, phrases.count, bits)

        return ask

    def report(table: pa.Table, replies: pa.Table) -> pa.Table:
        shard = _Shard(table, bits)
        got = answers(replies, most_words)
        return shard.report(shard.frequent_phrases(got, most_words, least), got[0] >= least)

    replies = scratch.enter_context(staged(exchange.ask(chunks, ask_words, exchange.count_reply), "phrase-words"))
    for sizes in range(1, most_words):
        more = exchange.ask(chunks, ask_phrases(sizes), exchange.count_reply, replies)
        replies = replies.union(scratch.enter_context(staged(exchange.next_question(more, bits, sizes), "phrase-replies")))
    parts = exchange.together(chunks, replies, report, COUNTS)
    summed = parts.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))
    return scratch.enter_context(staged(summed.where((F.col("size") == 0) | (F.col("f") >= least)), "phrase-counts"))


def _joined(words: Column, first: int, size: int) -> Column:
    return F.array_join(F.slice(words, first, size), " ")


def _cut_scores(counts: DataFrame, most_words: int) -> DataFrame:
    """(lang, phrase, size, a, l, r, score): every candidate with its lowest-scoring cut."""
    words = F.split("phrase", " ")
    cuts = F.array(*(F.struct(F.lit(k).alias("k"), _joined(words, 1, k).alias("first"), _joined(words, k + 1, most_words).alias("rest")) for k in range(1, most_words)))
    cut = (
        counts.where("size > 1")
        .select("lang", "size", "phrase", F.col("f").alias("a"), F.explode(F.filter(cuts, lambda c: c["k"] < F.col("size"))).alias("cut"))
        .select("lang", "size", "phrase", "a", "cut.k", F.explode(F.create_map(F.lit("l"), F.col("cut.first"), F.lit("r"), F.col("cut.rest"))).alias("side", "part"))
    )
    part = counts.where("size > 0").select("lang", F.col("phrase").alias("part"), F.col("f").alias("of_part"))
    both = cut.join(part, ["lang", "part"]).groupBy("lang", "phrase", "size", "a", "k").agg(
        F.max(F.when(F.col("side") == "l", F.col("of_part"))).alias("l"), F.max(F.when(F.col("side") == "r", F.col("of_part"))).alias("r")
    )
    exact = {c: f"CAST({c} AS DECIMAL(15, 0))" for c in "alr"}
    score = F.expr(f"(({exact['a']} * {exact['a']}) * CAST(1000000 AS DECIMAL(7, 0))) div ({exact['l']} * {exact['r']})")
    lowest = both.withColumn("score", score).groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return lowest.select("lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.score")


def _inside(counts: DataFrame, most_words: int) -> DataFrame:
    """(lang, phrase, longer): the most frequent longer candidate that holds a phrase."""
    words = F.split("phrase", " ")
    places = [(first, size) for size in range(2, most_words) for first in range(1, most_words - size + 2)]
    fits = [
        F.when((F.col("size") > size) & (F.col("size") >= first + size - 1), _joined(words, first, size)) for first, size in places
    ]
    found = counts.where("size > 2").select("lang", "f", F.explode(F.array_compact(F.array(*fits))).alias("phrase"))
    return found.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def phrase_mining(
    docs: DataFrame,
    most_words: int = 3,
    least: int = 10,
    share: int = 50,
    most: int = 2000,
    lang: str = "lang",
    text: str = "text",
    id_column: str = "doc_id",
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of 2 to `most_words` words of every language.

    A-Z are lower-cased. A text is cut into pieces at full stops, commas, semicolons, colons, exclamation and question marks and
    line ends, and pieces into words at spaces and tabs. n is the number of words of the language. A phrase is a
    candidate if it occurs a >= `least` times within pieces, overlaps included. Cut after k words it scores
    1000000 a a div (l r), where its parts occur l and r times; the lowest cut counts, the first of equal ones. A
    candidate goes if a longer one that holds it occurs at least `share` percent as often. Of the rest the first `most` are
    returned, by score, a and phrase in byte order.

    A null text is empty, a null language `und`. Repeated rows count each. Very long texts are indexed whole, in one
    shard. A table without candidates gives no rows. The id, if there is one, only helps to spread copies of a text. Other
    columns do not matter. `least` is at most 15.
    """
    if not (1 <= least <= 15 and most_words >= 2):
        raise ValueError("`least` must be from 1 to 15, `most_words` 2 or more")
    with ExitStack() as scratch:
        counts = phrase_counts(docs, most_words, least, lang, text, id_column, scratch)
        scored = _cut_scores(counts, most_words)
        if most_words > 2:
            scored = scored.join(_inside(counts, most_words), ["lang", "phrase"], "left").where(
                F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * share)
            )
        order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
        part = F.pmod(F.xxhash64("phrase"), F.lit(MERGE_PARTS))
        within = Window.partitionBy("lang", "part").orderBy(*order)
        few = scored.withColumn("part", part).withColumn("rank", F.row_number().over(within)).where(F.col("rank") <= most)
        best = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= most)
        totals = counts.where("size = 0").select("lang", F.col("f").alias("n"))
        result = best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
        return stage(result, "phrases")
