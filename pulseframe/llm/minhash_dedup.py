"""Near-duplicate documents by circulant MinHash, banding and exact verification.

1. Two permutations give all coordinates of a signature: the first one places a word n-gram in a
   circle of 2**32 places, the second one, turned by k places, ranks the places; coordinate k is
   the least rank of a document's n-grams. No document moves for this.
2. Equal sets form a class, which one document stands for from here on.
3. `rows` coordinates together are a band. Documents that agree in a band meet in its bucket. The
   smallest one is the bucket's hub; every other is compared with it, in groups of bounded size whose
   members are compared with each other too. Every comparison takes the full sets.
4. A bucket whose documents are still in several components is searched: those outside the
   hub's component ask all its members, in blocks. A pair is compared in the first band it shares.
5. Classes and links together give the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.llm import exchange
from pulseframe.llm.components import components
from pulseframe.llm.ngram_join import LINKS, _alike, _links, _Matrix, _spanning
from pulseframe.llm.rolling import OTHER_BASE, WHITE, Texts, Windows, mix, positions
from pulseframe.llm.spans import Spans, slices
from pulseframe.staging import stage, staged

SIGNATURES = "doc_id long, n_shingles long, one long, two long, bands array<long>"
SETS = "doc_id long, n_shingles long, tokens binary"

#: Coordinates of a band, and bands. Two sets of similarity 0.85 share no band with probability 7e-10.
ROWS, BANDS = 5, 36
#: Bytes of text that are hashed at once.
SLICE_BYTES = 1 << 20
#: Members of a group that are compared with each other, and documents that ask a group at once.
GROUP_SIZE = 64
ASKING = 256


def _place(x: np.ndarray) -> np.ndarray:
    """The first permutation: where an n-gram lies on the circle."""
    return (mix(x ^ OTHER_BASE) >> np.uint64(32)).astype(np.uint32)


def _rank(places: np.ndarray) -> np.ndarray:
    """The second permutation, a bijection of the circle's places that spreads every bit; changes its argument."""
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        places ^= places >> np.uint32(shift)
        places *= np.uint32(factor)
    places ^= places >> np.uint32(16)
    return places


def signature(tokens: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """(size, sets) least ranks; set i holds the tokens from starts[i] to the next start, at least one."""
    places = _place(tokens)
    out = np.empty((size, len(starts)), np.uint32)
    for k in range(size):
        # The second permutation turned by k places.
        out[k] = np.minimum.reduceat(_rank(places + np.uint32(k)), starts)
    return out


def band_keys(coordinates: np.ndarray, rows: int) -> np.ndarray:
    """(sets, bands) keys; different bands have different keys."""
    size, n = coordinates.shape
    keys = np.empty((n, size // rows), np.uint64)
    for band in range(size // rows):
        key = np.full(n, mix(np.array([band + 1], np.uint64))[0])
        for row in coordinates[band * rows : (band + 1) * rows]:
            key = mix(key * OTHER_BASE + row.astype(np.uint64))
        keys[:, band] = key
    return keys


def ngram_sets(texts: pa.ChunkedArray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, bounds): the distinct n-grams of every text, in order, and the range of each text's."""
    words = Spans(Texts(texts), WHITE, lower=True)
    named = words.hashes()
    start, owner = positions(words.bounds, size)
    windows = Windows(named)
    few = np.flatnonzero((words.count > 0) & (words.count < size))
    # A short text counts as one n-gram, unlike any longer one.
    whole = mix(windows.of(words.bounds[few], words.bounds[few + 1]) + words.count[few].astype(np.uint64))
    tokens, owner = np.concatenate([windows.of(start, start + size), whole]), np.concatenate([owner, few])
    order = np.lexsort((tokens, owner))
    tokens, owner = tokens[order], owner[order]
    fresh = np.ones(len(tokens), bool)
    fresh[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
    tokens, owner = tokens[fresh], owner[fresh]
    return tokens, np.searchsorted(owner, np.arange(len(texts) + 1))


def signatures(docs: DataFrame, size: int, rows: int, bands: int) -> DataFrame:
    """doc_id, n_shingles, a 128-bit name of the set, and the keys of its bands, of every row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                tokens, bounds = ngram_sets(part.column("text"), size)
                n = np.diff(bounds)
                filled = np.flatnonzero(n)
                one, two = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
                keys = np.empty((0, bands), np.uint64)
                if len(filled):
                    starts = bounds[:-1][filled]
                    one[filled] = np.add.reduceat(mix(tokens), starts)
                    two[filled] = np.add.reduceat(mix(tokens ^ OTHER_BASE), starts)
                    keys = band_keys(signature(tokens, starts, rows * bands), rows)
                ends = np.zeros(len(n) + 1, np.int32)
                ends[1:][filled] = bands
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum(ends).astype(np.int32)), pa.array(keys.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").combine_chunks(),
                        pa.array(n.astype(np.int64)),
                        pa.array(one.view(np.int64)),
                        pa.array(two.view(np.int64)),
                        lists,
                    ],
                    names=["doc_id", "n_shingles", "one", "two", "bands"],
                )

    return docs.mapInArrow(sign, SIGNATURES)


def _token_sets(docs: DataFrame, size: int) -> DataFrame:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                tokens, bounds = ngram_sets(part.column("text"), size)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").combine_chunks(),
                        pa.array(np.diff(bounds).astype(np.int64)),
                        pa.array([tokens[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "tokens"],
                )

    return docs.mapInArrow(of, SETS)


def _group_links(seated: DataFrame, share: Fraction) -> DataFrame:
    """A spanning forest of the links inside each group."""

    def links(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")
        ids, n = exchange.column(table, "doc_id"), exchange.column(table, "n_shingles")
        overlaps = _Matrix(table.column("tokens").to_pylist()).overlaps()
        return _links([(int(ids[a]), int(ids[b])) for a, b in _spanning(_alike(share, overlaps, n[:, None], n[None, :]))])

    return seated.groupBy("hub", "part").applyInArrow(links, LINKS)


def _hub_seats(shared: DataFrame, buckets: DataFrame) -> DataFrame:
    """(doc_id, hub, part): members of every hub in parts of bounded size, and the hub in each part."""
    members = shared.join(buckets.select("key", "hub"), "key").where("doc_id <> hub").select("doc_id", "hub").distinct()
    sizes = members.groupBy("hub").agg(F.count(F.lit(1)).alias("members"))
    parts = F.ceil(F.col("members") / F.lit(GROUP_SIZE)).cast("int")
    placed = members.join(sizes, "hub").select("doc_id", "hub", F.pmod(F.xxhash64("doc_id"), parts).cast("int").alias("part"))
    heads = sizes.select(F.col("hub").alias("doc_id"), "hub", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    return placed.union(heads)


def _search(shared: DataFrame, sets: DataFrame, labels: DataFrame, share: Fraction, scratch: ExitStack) -> DataFrame:
    """Links between documents of one bucket that are in different components so far."""
    named = shared.join(labels, "doc_id", "left").select("key", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    named = scratch.enter_context(staged(named, "minhash-named"))
    mixed = (
        named.groupBy("key")
        .agg(F.min(F.struct("doc_id", "component")).alias("head"), F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("n"))
        .where("low <> high")
        .select("key", F.col("head.component").alias("main"), "n")
    )
    inside = scratch.enter_context(staged(named.join(mixed, "key"), "minhash-mixed"))
    outside = F.col("component") != F.col("main")
    sizes = inside.groupBy("key").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(GROUP_SIZE)).cast("int").alias("parts"), F.ceil(F.count_if(outside) / F.lit(ASKING)).cast("int").alias("turns")
    )
    sized = inside.join(sizes, "key")
    part = F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int")
    turn = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("turns")).cast("int")
    members = sized.select("doc_id", "component", "key", part.alias("part"), F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"))
    asking = sized.where(outside).select("doc_id", "component", "key", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), turn.alias("turn"))

    def seated(seats: DataFrame) -> DataFrame:
        # Columns of their own for each side: both come from one table.
        rows = sets.join(seats, "doc_id")
        return rows.select(*(F.col(c).alias(c) for c in rows.columns))

    def search(group: pa.Table, asked: pa.Table) -> pa.Table:
        if not group.num_rows or not asked.num_rows:
            return _links([])
        ids, n, label = (exchange.column(group, c) for c in ("doc_id", "n_shingles", "component"))
        query, size, own = (exchange.column(asked, c) for c in ("doc_id", "n_shingles", "component"))
        key = group.column("key")[0].as_py()
        theirs, mine = (np.array(t.column("bands").to_pylist(), np.int64).reshape(t.num_rows, -1) for t in (group, asked))
        ratio = _alike(share, np.minimum(size[:, None], n[None, :]), size[:, None], n[None, :])
        open_ = (own[:, None] != label[None, :]) & ratio
        for band in range(mine.shape[1]):
            same = mine[:, band][:, None] == theirs[:, band][None, :]
            # The first band that a pair shares decides where it is compared.
            here = same & (mine[:, band] == key)[:, None]
            open_ &= ~same | here
            if here.any():
                break
        rows = np.flatnonzero(open_.any(axis=1))
        if not len(rows):
            return _links([])
        blobs = asked.column("tokens").to_pylist()
        overlaps = _Matrix(group.column("tokens").to_pylist()).overlaps([blobs[i] for i in rows])
        near = _alike(share, overlaps, size[rows][:, None], n[None, :]) & open_[rows]
        found = []
        for i, row in zip(rows, near):
            # One link with each component is enough.
            _, first = np.unique(label[row], return_index=True)
            found += [(int(query[i]), int(ids[row][f])) for f in first]
        return _links(found)

    keys = ["key", "part", "turn"]
    return seated(members).groupBy(keys).cogroup(seated(asking).groupBy(keys)).applyInArrow(search, LINKS)


def minhash_dedup(
    docs: DataFrame,
    size: int = 5,
    threshold: float = 0.85,
    rows: int = ROWS,
    bands: int = BANDS,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, class_id for every row.

    A document's set holds the distinct runs of `size` consecutive words; words are separated by
    ASCII white space and A-Z are lower-cased. A text with fewer words is one n-gram; one without
    words, or null, has an empty set and links with nothing. Two documents link when the overlap of
    their sets is at least `threshold` of the union. class_id is the smallest id with the same set,
    component_id the smallest id reachable over links, and the document of that id is kept.

    Rows that share an id are one document to the links; each is returned with its own size. A row
    without an id links with nothing and is kept; its component_id and class_id are null. Very long texts are
    hashed whole, each alone. Other columns are ignored. An empty table gives no rows.
    """
    share = Fraction(threshold).limit_denominator(1000)
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    same = ["one", "two", "n_shingles"]
    with ExitStack() as scratch:
        keep = lambda df, name: scratch.enter_context(staged(df, name))
        signed = keep(signatures(source, size, rows, bands), "minhash-signatures")
        filled = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
        classes = keep(filled.groupBy(same).agg(F.min("doc_id").alias("class_id")), "minhash-classes")
        standing = classes.select(F.col("class_id").alias("doc_id"), *same)
        reps = filled.join(standing, ["doc_id", *same], "left_semi").dropDuplicates(["doc_id", *same])
        reps = keep(reps.select("doc_id", "n_shingles", "bands"), "minhash-representatives")
        spread = reps.select("doc_id", F.explode("bands").alias("key"))
        buckets = spread.groupBy("key").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("last")).where("hub <> last")
        buckets = keep(buckets.select("key", "hub"), "minhash-buckets")
        shared = keep(spread.join(buckets.select("key"), "key"), "minhash-shared")
        wanted = keep(shared.select("doc_id").distinct(), "minhash-wanted")
        # Of rows that share an id all come along.
        sets = _token_sets(source.join(wanted, "doc_id", "left_semi"), size).where("n_shingles > 0").dropDuplicates(["doc_id", "tokens"])
        sets = keep(sets, "minhash-sets")
        seats = keep(_hub_seats(shared, buckets), "minhash-seats")
        near = keep(_group_links(sets.join(seats, "doc_id"), share), "minhash-links")
        labels = components(near).withColumnRenamed("id", "doc_id")
        keyed = sets.join(reps, ["doc_id", "n_shingles"])
        far = keep(_search(shared, keyed, labels, share, scratch), "minhash-links")
        # Rows of one id with different sets link the classes of these.
        name = F.struct(*same)
        several = filled.groupBy("doc_id").agg(F.min(name).alias("low"), F.max(name).alias("high")).where("low <> high").select("doc_id")
        bridges = filled.join(several, "doc_id").join(classes, same).select(F.col("doc_id").alias("a"), F.col("class_id").alias("b"))
        found = components(near.union(far).union(bridges)).withColumnRenamed("id", "class_id")
        labelled = classes.join(found, "class_id", "left").select(*same, "class_id", F.coalesce("component", "class_id").alias("label"))
        label = F.coalesce("label", "doc_id")
        named = F.col("doc_id").isNotNull()
        result = signed.select("doc_id", *same).join(labelled, same, "left").select(
            "doc_id",
            "n_shingles",
            F.when(named, label).alias("component_id"),
            (~named | (F.col("doc_id") == label)).alias("kept"),
            F.when(named, F.coalesce("class_id", "doc_id")).alias("class_id"),
        )
        return stage(result, "minhash-documents")
