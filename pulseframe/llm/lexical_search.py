"""The best documents of every query by term frequencies, from a length-stratified index.

A document's length enters its score only through an integer normaliser m, so documents of equal m
form a stratum. The index of a shard holds its documents by stratum and, for each stratum and term, the
postings by falling term frequency. An impact depends on (m, tf) alone and is computed once for each
pair. The largest frequency of every term in a stratum bounds the score of all its documents. A query visits strata by
falling bound and stops where the bound is below its k-th best score, in the shard or, from a few
shards searched first, anywhere.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulseframe.llm.rolling import Texts
from pulseframe.llm.spans import Spans, byte_set, slices
from pulseframe.staging import stage, staged

#: Fixed value: bytes between terms. A-Z belong to terms and are folded.
GAPS = byte_set(range(0x00, 0x30), range(0x3A, 0x41), range(0x5B, 0x61), range(0x7B, 0x80))

#: Documents and postings of a shard, about.
SHARD_DOCUMENTS = 4096
SHARD_POSTINGS = 1 << 18
#: Queries that search a shard together.
QUERIES_TOGETHER = 256
#: Query terms up to this number (16 MB) are sent to the tasks that read documents, which then keep no other postings.
MOST_TERMS = 2_000_000
#: Shards that are searched first, for scores that the best must reach.
SEED_SHARDS = 4
#: Parts of a query's results that are merged before all of them meet.
MERGE_PARTS = 64
SLICE_BYTES = 2 << 20
#: Whole numbers below this are exact in double arithmetic.
EXACT = 1 << 53
#: What an impact stays below.
MOST_IMPACT = 1_000_000

FORWARD = "doc_id long, n long, terms binary, tf binary"
INDEX = "shard int, ids binary, named binary, stratum_m binary, doc_bounds binary, cell_term binary, cell_stratum binary, posting_bounds binary, docs binary, tf binary"
BLOCKS = "turn int, queries binary, terms binary, weights binary, bounds binary, least binary"
FOUND = "query long, doc_id long, score long"


def _counts(texts: pa.ChunkedArray, vocabulary: np.ndarray | None):
    """Terms of every text with repeats, and its distinct (wanted) terms with their frequencies."""
    spans = Spans(Texts(texts), GAPS, lower=True)
    terms, owner = spans.hashes(), spans.owner()
    if vocabulary is not None:
        at = np.minimum(np.searchsorted(vocabulary, terms), max(len(vocabulary) - 1, 0))
        wanted = vocabulary[at] == terms if len(vocabulary) else np.zeros(len(terms), bool)
        terms, owner = terms[wanted], owner[wanted]
    order = np.lexsort((terms, owner))
    terms, owner = terms[order], owner[order]
    fresh = np.ones(len(terms), bool)
    fresh[1:] = (terms[1:] != terms[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(fresh)
    tf = np.diff(np.concatenate([at, [len(terms)]]))
    return spans.count, terms[at], tf, np.searchsorted(owner[at], np.arange(len(texts) + 1))


def _forward(docs: DataFrame, vocabulary) -> DataFrame:
    """doc_id, n, and the postings of a document; `vocabulary` is a broadcast of the terms to keep, or None for all."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = None if vocabulary is None else vocabulary.value
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                n, terms, tf, bounds = _counts(part.column("text"), keep)
                tf = tf.astype(np.uint32)
                cut = list(zip(bounds[:-1], bounds[1:]))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").combine_chunks(),
                        pa.array(n.astype(np.int64)),
                        pa.array([terms[a:b].tobytes() for a, b in cut], pa.binary()),
                        pa.array([tf[a:b].tobytes() for a, b in cut], pa.binary()),
                    ],
                    names=["doc_id", "n", "terms", "tf"],
                )

    return docs.mapInArrow(read, FORWARD)


def _query_terms(queries: DataFrame) -> DataFrame:
    """(query, term, times) of the distinct terms of every query."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                _, terms, tf, bounds = _counts(part.column("text"), None)
                rows = np.repeat(part.column("query").to_numpy(), np.diff(bounds))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows, pa.int64()), pa.array(terms.view(np.int64)), pa.array(tf.astype(np.int64))], names=["query", "term", "times"]
                )

    return queries.mapInArrow(read, "query long, term long, times long")


def _blobs(column: pa.ChunkedArray, dtype) -> list[np.ndarray]:
    return [np.frombuffer(b, dtype) for b in column.to_pylist()]


def _shard_index(table: pa.Table, total_docs: int, total_terms: int) -> pa.Table:
    """One row: the shard's documents by (m, id) and its postings by (stratum, term, falling tf)."""
    given = table.column("doc_id").combine_chunks()
    ids, named = given.fill_null(0).to_numpy(zero_copy_only=False), given.is_valid().to_numpy(zero_copy_only=False)
    # Python integers: 25 * n * N may pass 64 bits.
    m = np.array([75 + 25 * n * total_docs // total_terms for n in table.column("n").to_pylist()], np.int64)
    order = np.lexsort((ids, m))
    terms, tf = (_blobs(table.column(c), d) for c, d in (("terms", np.uint64), ("tf", np.uint32)))
    place = np.repeat(np.arange(len(ids)), [len(terms[i]) for i in order])
    terms, tf = (np.concatenate([x[i] for i in order]) for x in (terms, tf))
    strata, first = np.unique(m[order], return_index=True)
    doc_bounds = np.concatenate([first, [len(ids)]])
    stratum = np.searchsorted(first, place, "right") - 1
    by = np.lexsort((place, -tf.astype(np.int64), terms, stratum))
    terms, tf, place, stratum = terms[by], tf[by], place[by], stratum[by]
    fresh = np.ones(len(terms), bool)
    fresh[1:] = (terms[1:] != terms[:-1]) | (stratum[1:] != stratum[:-1])
    cells = np.flatnonzero(fresh)
    held = {
        "ids": ids[order],
        "named": named[order].astype(np.uint8),
        "stratum_m": strata,
        "doc_bounds": doc_bounds.astype(np.int64),
        "cell_term": terms[cells],
        "cell_stratum": stratum[cells].astype(np.int32),
        "posting_bounds": np.concatenate([cells, [len(terms)]]).astype(np.int64),
        "docs": place.astype(np.int32),
        "tf": tf,
    }
    return pa.table({"shard": table.column("shard").slice(0, 1), **{k: pa.array([v.tobytes()], pa.binary()) for k, v in held.items()}})


def impact(tf, m):
    """What one unit of term weight adds to a document of normaliser m that holds the term tf times."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


class Shard:
    """A shard's index, for queries by term."""

    def __init__(self, row: dict):
        read = lambda name, kind: np.frombuffer(row[name], kind)
        self.ids, self.m, self.doc_bounds = read("ids", np.int64), read("stratum_m", np.int64), read("doc_bounds", np.int64)
        self.named = read("named", np.uint8).astype(bool)
        cell_term, cell_stratum = read("cell_term", np.uint64), read("cell_stratum", np.int32)
        self.posting_bounds, self.docs = read("posting_bounds", np.int64), read("docs", np.int32)
        tf, sizes = read("tf", np.uint32).astype(np.int64), np.diff(self.posting_bounds)
        # Each pair (m, tf) has one impact.
        pairs, which = np.unique(np.repeat(cell_stratum, sizes).astype(np.int64) << 32 | tf, return_inverse=True)
        self.impacts = impact(pairs & 0xFFFFFFFF, self.m[pairs >> 32])[which] if len(pairs) else np.empty(0, np.int64)
        # Cells by term: those of one term lie together, by stratum.
        self.cells = np.lexsort((cell_stratum, cell_term))
        self.terms, at = np.unique(cell_term[self.cells], return_index=True)
        self.term_bounds = np.concatenate([at, [len(self.cells)]])
        self.stratum = cell_stratum
        # Postings fall in tf, so a cell's first impact is its largest.
        self.most = self.impacts[self.posting_bounds[:-1]] if len(sizes) else np.empty(0, np.int64)

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of the k best documents with a score of `least` or more; ties at the end are all there."""
        none = np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.searchsorted(self.terms, terms)
        known = at < len(self.terms)
        known[known] = self.terms[at[known]] == terms[known]
        at, weights = at[known], weights[known]
        most = MOST_IMPACT * sum(map(int, weights))
        sizes = self.term_bounds[at + 1] - self.term_bounds[at]
        cells = self.cells[_ranges(self.term_bounds[at], sizes)]
        cell_weight = np.repeat(weights, sizes)
        if not len(cells):
            return none
        bounds = _sums(cell_weight * self.most[cells], self.stratum[cells], len(self.m), most)
        visits = np.argsort(-bounds, kind="stable")
        visits = visits[bounds[visits] >= max(least, 1)]
        place, score = none
        done, together = 0, 1
        by_stratum = np.argsort(self.stratum[cells], kind="stable")
        cells, cell_weight = cells[by_stratum], cell_weight[by_stratum]
        cell_at = np.searchsorted(self.stratum[cells], np.arange(len(self.m) + 1))
        while done < len(visits) and bounds[visits[done]] >= least:
            chosen = visits[done : done + together]
            chosen = chosen[bounds[chosen] >= least]
            mine = _ranges(cell_at[chosen], cell_at[chosen + 1] - cell_at[chosen])
            sizes = self.posting_bounds[cells[mine] + 1] - self.posting_bounds[cells[mine]]
            postings = _ranges(self.posting_bounds[cells[mine]], sizes)
            docs, slot = np.unique(self.docs[postings], return_inverse=True)
            scores = _sums(np.repeat(cell_weight[mine], sizes) * self.impacts[postings], slot, len(docs), most)
            good = (scores >= max(least, 1)) & self.named[docs]
            place, score = np.concatenate([place, docs[good]]), np.concatenate([score, scores[good]])
            if len(score) >= k:
                # What is worse than the k-th best is out; equals are decided by id.
                kth = int(-np.partition(-score, k - 1)[k - 1])
                least = max(least, kth)
                place, score = place[score >= kth], score[score >= kth]
            done, together = done + len(chosen), together * 2
        return place, score


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the ranges, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _sums(values: np.ndarray, slots: np.ndarray, n: int, most: int) -> np.ndarray:
    """Exact sums by slot, none above `most`; raises if that passes a 64-bit integer."""
    if most >= 1 << 63:
        raise OverflowError("a score may pass 64 bits")
    if most < EXACT:
        return np.bincount(slots, weights=values.astype(np.float64), minlength=n).astype(np.int64)
    out = np.zeros(n, np.int64)
    np.add.at(out, slots, values)
    return out


def _blocks(weighted: DataFrame, least: DataFrame | None) -> DataFrame:
    """Queries by turn: their terms and weights in one row."""
    rows = weighted.withColumn("least", F.lit(1).cast("long")) if least is None else weighted.join(F.broadcast(least), "query", "left").fillna(1, ["least"])

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("query", "ascending"), ("term", "ascending")])
        column = lambda c: table.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
        names, at = np.unique(column("query"), return_index=True)
        held = [names, column("term"), column("weight"), np.concatenate([at, [table.num_rows]]).astype(np.int64), column("least")[at]]
        blobs = [pa.array([x.tobytes()], pa.binary()) for x in held]
        return pa.table([table.column("turn").slice(0, 1), *blobs], names=["turn", "queries", "terms", "weights", "bounds", "least"])

    return rows.groupBy("turn").applyInArrow(pack, BLOCKS)


def _search(index: DataFrame, blocks: DataFrame, shards: int, k: int) -> DataFrame:
    """(query, doc_id, score): the best of every shard for every query that can be among the best of all."""

    def search(shard: pa.Table, asked: pa.Table) -> pa.Table:
        found = [np.empty((3, 0), np.int64)]
        if shard.num_rows:
            index = Shard(shard.to_pylist()[0])
            for row in asked.to_pylist():
                names, terms, weights, bounds, least = (
                    np.frombuffer(row[c], np.uint64 if c == "terms" else np.int64) for c in ("queries", "terms", "weights", "bounds", "least")
                )
                for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
                    place, score = index.best(terms[a:b], weights[a:b], k, int(least[i]))
                    best = np.lexsort((index.ids[place], -score))[:k]
                    found.append(np.stack([np.full(len(best), names[i]), index.ids[place[best]], score[best]]))
        columns = np.concatenate(found, axis=1)
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query", "doc_id", "score"])

    # A block goes to every shard: each is a small part of what it meets.
    sent = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    return index.groupBy("shard").cogroup(sent.groupBy("shard")).applyInArrow(search, FOUND)


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The k best of every query with their ranks; parts of a query are cut before they meet."""
    order = [F.desc("score"), F.asc("doc_id")]
    part = F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(MERGE_PARTS))
    within = Window.partitionBy("query", "part").orderBy(*order)
    few = found.withColumn("part", part).withColumn("rank", F.row_number().over(within)).where(F.col("rank") <= k)
    return few.drop("part").withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= k)


def lexical_search(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id_column: str = "doc_id",
    text: str = "text",
    query_column: str = "item_id",
    query_text: str = "text",
) -> DataFrame:
    """query_column, rank, doc_id, score: the k best documents of every query with a score above 0, ties to smaller ids.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII; A-Z are lower-cased. N is the number of
    documents with a term, L that of all their terms, n that of a document's terms, df that of documents with a
    term, tf how often a document holds it. A term weighs floor(1000 ln((2N+2) / (2df+1))), a document's m is 75 + 25nN div L, and
    its score is the sum over the query's terms, repeats included, of weight * (10**9 tf div (1000 tf + 12 m)).

    Null and empty texts have no terms. Rows that share an id are documents, or queries, each of its own. A
    document without an id counts for N, L and df but is never a result; a query without an id has none. Texts of any length are
    read whole. Empty tables give no rows. Other columns are ignored.
    """
    with ExitStack() as scratch:
        keep = lambda df, name: scratch.enter_context(staged(df, name))
        named = queries.where(F.col(query_column).isNotNull()).select(
            F.monotonically_increasing_id().alias("query"), F.col(query_column).alias("name"), F.col(query_text).cast("string").alias("text")
        )
        named = keep(named, "lexical-queries")
        wanted = keep(_query_terms(named.select("query", "text")), "lexical-terms")
        terms = wanted.select("term").distinct()
        count = terms.count()
        context = docs.sparkSession.sparkContext
        vocabulary = None
        if count <= MOST_TERMS:
            vocabulary = context.broadcast(np.sort(terms.toArrow().column(0).to_numpy().view(np.uint64)))
        source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
        forward = keep(_forward(source, vocabulary), "lexical-forward")
        if vocabulary is not None:
            vocabulary.destroy()
        total, length, held, postings = forward.where("n > 0").agg(
            F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.length("terms") > 0), F.coalesce(F.sum(F.length("tf")), F.lit(0)) / 4
        ).first()
        shards = max(1, math.ceil(held / SHARD_DOCUMENTS), math.ceil(postings / SHARD_POSTINGS))
        dealt = forward.where("length(terms) > 0").withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).cast("int"))
        # Documents without an id are counted, in the index's frequencies, but not ranked.
        index = keep(dealt.groupBy("shard").applyInArrow(lambda t: _shard_index(t, total, max(length, 1)), INDEX), "lexical-index")
        df = keep(_frequencies(index), "lexical-frequencies")
        weight = F.floor(F.lit(1000.0) * F.ln((2.0 * total + 2.0) / (2.0 * F.col("df") + 1.0))).cast("long") * F.col("times")
        turns = max(1, math.ceil(named.count() / QUERIES_TOGETHER))
        weighted = wanted.join(df, "term").select("query", "term", weight.alias("weight"), F.pmod(F.xxhash64("query"), F.lit(turns)).cast("int").alias("turn"))
        weighted = keep(weighted, "lexical-weights")
        seeds = index.where(F.col("shard") < SEED_SHARDS)
        first = _merged(_search(seeds, _blocks(weighted, None), min(shards, SEED_SHARDS), k), k)
        least = keep(first.where(F.col("rank") == k).select("query", F.col("score").alias("least")), "lexical-least")
        found = _merged(_search(index, _blocks(weighted, least), shards, k), k)
        result = found.join(named.select("query", "name"), "query").select(
            F.col("name").alias(query_column), F.col("rank").cast("int").alias("rank"), "doc_id", "score"
        )
        return stage(result, "lexical-results")


def _frequencies(index: DataFrame) -> DataFrame:
    """(term, df), from each shard's own count of every term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                terms, which = np.unique(np.frombuffer(row["cell_term"], np.uint64), return_inverse=True)
                n = np.bincount(which, weights=np.diff(np.frombuffer(row["posting_bounds"], np.int64)), minlength=len(terms)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(n)], names=["term", "n"])

    return index.select("cell_term", "posting_bounds").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("df"))
