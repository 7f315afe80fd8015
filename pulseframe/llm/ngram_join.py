"""Links between documents whose word n-gram sets are alike, by a token-group matrix.

1. Every n-gram learns in how many documents it occurs (packed counts, no documents moved). A
   document of whose n-grams fewer than `threshold` occur elsewhere has no partner and is done.
2. Equal sets form a class, which one document stands for from here on.
3. Similar documents are partitioned into groups: those that agree most with one leader in
   min-hashes, dealt over groups of bounded size that each hold the leader. A group's
   part of the matrix, members by n-grams, gives all links inside it at once.
4. Every document queries the groups it is not yet connected with. In a common order of the
   n-grams, rare ones first, two similar documents share one of their first few, so these name
   the groups to ask. A group's n-gram union bounds the overlap with any member, and
   only groups whose bound reaches the threshold are opened.
5. Classes and links together give the components.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.llm import exchange
from pulseframe.llm.components import components
from pulseframe.llm.rolling import OTHER_BASE, Texts, Windows, Words, mix, positions
from pulseframe.staging import stage, stage_bucketed

SETS = "doc_id long, n_shingles long, one long, two long, sketch array<long>, probe array<long>, n_index int, n_held int, tokens binary"
LINKS = "a long, b long"

#: Members of a group, its leader apart.
GROUP_SIZE = 64
#: Queries that one task compares with a group.
QUERIES_AT_ONCE = 512
#: Min-hashes by which documents find their leader.
SKETCH = 4
#: Text of which the sets lie in one bucket of the table of sets.
SET_BUCKET_BYTES = 32 << 20
#: Columns of a group's matrix that are in memory at once.
MATRIX_COLUMNS = 1 << 16

_SEEDS = mix(np.arange(1, SKETCH + 1, dtype=np.uint64))


def _shingles(table: pa.Table, size: int, bits: int):
    """A chunk's rows with an id, its distinct n-grams, and (document, place of the n-gram) of every set member."""
    rows = exchange.in_order(table)
    words = Words(Texts(rows.column("text")), lower=True)
    start, owner = positions(words.bounds, size)
    hashes = Windows(words.hashes).of(start, start + size)
    few = np.flatnonzero((words.count > 0) & (words.count < size))
    whole = Windows(words.hashes).of(words.bounds[few], words.bounds[few + 1])
    # A short text counts as one n-gram, unlike any longer one.
    whole = mix(whole + words.count[few].astype(np.uint64))
    hashes, owner = np.concatenate([hashes, whole]), np.concatenate([owner, few])
    keys, place, _ = exchange.distinct(hashes, bits)
    members = np.unique(owner.astype(np.int64) << 32 | place)
    return rows, keys, members >> 32, members & 0xFFFFFFFF


def _least_overlap(threshold: Fraction, size: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The overlap from which two sets of these sizes are alike."""
    p, q = threshold.numerator, threshold.denominator
    return -(-p * (size + other) // (p + q))


def _alike(threshold: Fraction, overlap, size, other):
    return overlap >= _least_overlap(threshold, size, other)


def _set_rows(rows: pa.Table, keys: np.ndarray, owner: np.ndarray, place: np.ndarray, levels: np.ndarray, threshold: Fraction) -> pa.Table:
    ids = exchange.column(rows, "doc_id")
    n = np.bincount(owner, minlength=len(ids))
    level, token = levels[place], keys[place]
    shared = np.bincount(owner[level >= 2], minlength=len(ids))
    p, q = threshold.numerator, threshold.denominator
    open_ = (n > 0) & (q * shared >= p * n)
    one = np.zeros(len(ids), np.uint64)
    two = np.zeros(len(ids), np.uint64)
    np.add.at(one, owner, mix(token))
    np.add.at(two, owner, mix(token ^ OTHER_BASE))
    order = np.lexsort((token, level, owner))
    owner, token, level = owner[order], token[order], level[order]
    bounds = np.searchsorted(owner, np.arange(len(ids) + 1))
    sketch, probe, n_index, n_held, tokens = [], [], [], [], []
    for i in range(len(ids)):
        if not open_[i]:
            sketch.append(None), probe.append(None), n_index.append(None), n_held.append(None), tokens.append(None)
            continue
        lo, hi = bounds[i], bounds[i + 1]
        alone = int(n[i] - shared[i])
        held = token[lo + alone : hi]
        size = int(n[i])
        # Overlap with a document that is not larger, at least; and with one that is not smaller.
        n_probe = size - -(-p * size // q) + 1
        n_first = size - -(-2 * p * size // (p + q)) + 1
        probe.append(held[: max(0, n_probe - alone)].view(np.int64))
        n_index.append(max(0, n_first - alone))
        n_held.append(len(held))
        sketch.append([int(mix(held ^ seed).min().view(np.int64)) for seed in _SEEDS])
        tokens.append(held.tobytes())
    return pa.table(
        {
            "doc_id": pa.array(ids, pa.int64()),
            "n_shingles": pa.array(n, pa.int64()),
            "one": pa.array(one.view(np.int64), pa.int64()),
            "two": pa.array(two.view(np.int64), pa.int64()),
            "sketch": pa.array(sketch, pa.list_(pa.int64())),
            "probe": pa.array(probe, pa.list_(pa.int64())),
            "n_index": pa.array(n_index, pa.int32()),
            "n_held": pa.array(n_held, pa.int32()),
            "tokens": pa.array(tokens, pa.binary()),
        }
    )


class _Matrix:
    """Members of a group by n-grams; rows are sorted n-gram sets."""

    def __init__(self, blobs: list[bytes]):
        sets = [np.frombuffer(b, np.uint64) for b in blobs]
        tokens = np.concatenate(sets)
        self.rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        self.union, self.columns = np.unique(tokens, return_inverse=True)
        self.n = len(sets)

    def overlaps(self, blobs: list[bytes] | None = None) -> np.ndarray:
        """Overlap of every given set, or member, with every member."""
        if blobs is None:
            rows, columns, n = self.rows, self.columns, self.n
        else:
            sets = [np.frombuffer(b, np.uint64) for b in blobs]
            rows, tokens, n = np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate(sets), len(sets)
            columns = np.minimum(np.searchsorted(self.union, tokens), len(self.union) - 1)
            known = self.union[columns] == tokens
            rows, columns = rows[known], columns[known]
        total = np.zeros((n, self.n), np.float64)
        for at in range(0, len(self.union), MATRIX_COLUMNS):
            width = min(MATRIX_COLUMNS, len(self.union) - at)
            mine, theirs = np.zeros((self.n, width), np.float32), np.zeros((n, width), np.float32)
            chosen = (self.columns >= at) & (self.columns < at + width)
            mine[self.rows[chosen], self.columns[chosen] - at] = 1
            chosen = (columns >= at) & (columns < at + width)
            theirs[rows[chosen], columns[chosen] - at] = 1
            total += theirs @ mine.T
        return np.rint(total).astype(np.int64)

    def bounds(self, blobs: list[bytes]) -> np.ndarray:
        """Overlap of every given set with the union of the members."""
        found = []
        for b in blobs:
            tokens = np.frombuffer(b, np.uint64)
            at = np.minimum(np.searchsorted(self.union, tokens), len(self.union) - 1)
            found.append(int((self.union[at] == tokens).sum()))
        return np.array(found, np.int64)


def _links(pairs: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())})


def _spanning(near: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a forest that connects what `near` connects."""
    seen = np.zeros(len(near), bool)
    edges = []
    for root in range(len(near)):
        if seen[root]:
            continue
        seen[root] = True
        stack = [root]
        while stack:
            at = stack.pop()
            for other in np.flatnonzero(near[at] & ~seen):
                seen[other] = True
                edges.append((at, int(other)))
                stack.append(int(other))
    return edges


def ngram_join(docs: DataFrame, size: int = 5, threshold: float = 0.75, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, class_id for every document.

    A document's set holds the distinct runs of `size` consecutive words; words are separated by
    ASCII white space and A-Z are lower-cased. A text with fewer words is one n-gram; one without
    words, or null, has an empty set and links with nothing. Two documents link when the
    overlap of their sets is at least `threshold` of the union. class_id is the smallest id with the
    same set, component_id the smallest id reachable over links.

    Rows that share an id are one document to the links; each is returned with its own size. Rows
    without an id are left out: nothing names them. Other columns are ignored.
    """
    share = Fraction(threshold).limit_denominator(1000)
    plan = exchange.layout(docs, text)
    bits = plan.bucket_bits
    chunks = exchange.chunked(docs, plan, id_column, text)

    def request(table: pa.Table) -> pa.Table:
        _, keys, _, place = _shingles(table, size, bits)
        return exchange.count_request(int(table.column("chunk")[0].as_py()), keys, np.bincount(place, minlength=len(keys)), bits)

    def sets_of(table: pa.Table, replies: pa.Table) -> pa.Table:
        rows, keys, owner, place = _shingles(table, size, bits)
        return _set_rows(rows, keys, owner, place, exchange.answers(replies), share)

    counts = exchange.ask(chunks, request, exchange.count_reply)
    sets = stage(exchange.together(chunks, counts, sets_of, SETS), "ngram-sets")

    # In buckets by id: whatever is joined with the sets moves to them, and they stay where they are.
    buckets = max(1, -(-plan.chunks * exchange.CHUNK_BYTES // SET_BUCKET_BYTES))
    alive = stage_bucketed(sets.where("tokens is not null"), "doc_id", buckets, "ngram-alive")
    same = ["one", "two", "n_shingles"]
    firsts = alive.groupBy(same).agg(F.min("doc_id").alias("class_id"))
    classes = stage(alive.select("doc_id", *same).join(firsts, same).groupBy("doc_id", *same).agg(F.min("class_id").alias("class_id")), "ngram-classes")
    standing = classes.where("doc_id = class_id").select("doc_id", *same)
    leaders = _leaders(alive.select("doc_id", *same, "sketch").join(standing, ["doc_id", *same], "left_semi"))
    # From here on tables name representatives only, so the sets are joined as they lie.
    inside = stage(_inside(leaders, alive, share), "ngram-links")
    parts = components(inside)
    grouped = leaders.join(parts.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "doc_id", "leader", "part", F.coalesce("component", "doc_id").alias("component")
    )
    grouped = stage(grouped, "ngram-groups")
    across = stage(_across(grouped, alive, share), "ngram-links")
    same_set = classes.where("doc_id <> class_id").select(F.col("doc_id").alias("a"), F.col("class_id").alias("b"))
    found = components(inside.union(across).union(same_set)).withColumnRenamed("id", "doc_id")
    return (
        sets.select("doc_id", *same)
        .join(classes, ["doc_id", *same], "left")
        .join(found, "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"), F.coalesce("class_id", "doc_id").alias("class_id"))
    )


def _leaders(reps: DataFrame) -> DataFrame:
    """(doc_id, leader, part): the smallest id among those that agree in the most min-hashes; itself if none does."""
    votes = reps.select("doc_id", F.posexplode("sketch").alias("i", "value"))
    first = votes.groupBy("i", "value").agg(F.min("doc_id").alias("leader"))
    agreed = votes.join(first, ["i", "value"]).groupBy("doc_id", "leader").agg(F.count(F.lit(1)).alias("n"))
    best = agreed.groupBy("doc_id").agg(F.max_by("leader", F.struct("n", -F.col("leader"))).alias("leader"))
    sizes = best.groupBy("leader").agg(F.count(F.lit(1)).alias("members"))
    parts = F.ceil(F.col("members") / F.lit(GROUP_SIZE))
    placed = best.join(sizes, "leader").select(
        "doc_id", "leader", F.pmod(F.xxhash64("doc_id"), parts).cast("int").alias("part"), parts.cast("int").alias("parts"), "members"
    )
    return stage(placed, "ngram-leaders")


def _inside(leaders: DataFrame, sets: DataFrame, share: Fraction) -> DataFrame:
    """A spanning forest of the links inside each group and with its leader."""
    crowded = leaders.where("members > 1 or doc_id <> leader")
    members = crowded.select("doc_id", "leader", "part")
    heads = crowded.select(F.col("leader").alias("doc_id"), "leader", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).distinct()
    seats = members.union(heads).distinct().groupBy("doc_id").agg(F.collect_set(F.struct("leader", "part")).alias("seats"))
    seated = sets.select("doc_id", "n_shingles", "tokens").join(seats, "doc_id")
    seated = seated.select("doc_id", "n_shingles", "tokens", F.explode("seats").alias("seat"))
    seated = seated.selectExpr("doc_id", "n_shingles", "tokens", "seat.leader AS leader", "seat.part AS part")

    def links(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")
        ids, n = exchange.column(table, "doc_id"), exchange.column(table, "n_shingles")
        overlaps = _Matrix(table.column("tokens").to_pylist()).overlaps()
        near = _alike(share, overlaps, n[:, None], n[None, :])
        return _links([(int(ids[a]), int(ids[b])) for a, b in _spanning(near)])

    return seated.groupBy("leader", "part").applyInArrow(links, LINKS)


def _spread(rows: DataFrame) -> DataFrame:
    """A row for each seat, under column identities of its own: both sides come from one table."""
    own = [F.col(name).alias(name) for name in ("doc_id", "n_shingles", "tokens")]
    seats = [F.col(f"seat.{name}").alias(name) for name in ("leader", "part", "turn", "component")]
    return rows.withColumn("seat", F.explode("seats")).select(*own, *seats)


def _across(grouped: DataFrame, sets: DataFrame, share: Fraction) -> DataFrame:
    """Links between documents that links inside groups do not connect yet."""
    p, q = share.numerator, share.denominator
    ranked = sets.select("doc_id", "n_shingles", "probe", "n_index", "n_held").join(grouped, "doc_id")
    # Two sets share, beside their first common n-gram, no more than what follows it in either.
    following = (F.col("n_held") - F.col("place") - 1).alias("following")
    index = (
        ranked.where("n_index > 0")
        .select("leader", "part", "component", "n_shingles", "n_held", F.posexplode(F.slice("probe", F.lit(1), F.col("n_index"))).alias("place", "token"))
        .select("leader", "part", "component", "n_shingles", "token", following)
        .groupBy("token", "leader", "part", "component")
        .agg(F.min("n_shingles").alias("least"), F.max("n_shingles").alias("most"), F.max("following").alias("theirs"))
    )
    asking = ranked.select(
        "doc_id", F.col("n_shingles").alias("n"), F.col("component").alias("own"), "n_held", F.posexplode("probe").alias("place", "token")
    ).select("doc_id", "n", "own", "token", following)
    smallest = F.greatest("least", F.expr(f"n * {p} div {q}"))
    enough = (F.least("following", "theirs") + 1) * (p + q) >= (F.col("n") + smallest) * p
    asked = (
        asking.join(index, "token")
        .where((F.col("own") != F.col("component")) & (F.col("n") >= F.col("least")) & (F.col("n") * p <= F.col("most") * q) & enough)
        .select(F.col("doc_id"), "leader", "part", "component")
        .distinct()
    )
    asked = stage(asked, "ngram-queries")
    # One task compares a bounded number of queries with a group, which is repeated if there are more.
    busy = asked.groupBy("leader", "part").agg(F.ceil(F.count(F.lit(1)) / F.lit(QUERIES_AT_ONCE)).cast("int").alias("turns"))
    busy = stage(busy, "ngram-busy")
    queries = asked.join(busy, ["leader", "part"]).select(
        "doc_id", F.struct("leader", "part", F.pmod(F.xxhash64("doc_id"), F.col("turns")).cast("int").alias("turn"), "component").alias("seat")
    )
    queries = queries.groupBy("doc_id").agg(F.collect_set("seat").alias("seats"))
    members = grouped.join(busy, ["leader", "part"]).select(
        "doc_id", "component", "leader", "part", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn")
    )
    members = members.groupBy("doc_id").agg(F.collect_set(F.struct("leader", "part", "turn", "component")).alias("seats"))
    rows = sets.select("doc_id", "n_shingles", "tokens")
    left, right = _spread(rows.join(members, "doc_id")), _spread(rows.join(queries, "doc_id"))

    def opened(group: pa.Table, asked: pa.Table) -> pa.Table:
        if not group.num_rows or not asked.num_rows:
            return _links([])
        ids, n, part = (exchange.column(group, c) for c in ("doc_id", "n_shingles", "component"))
        query, size, wanted = (exchange.column(asked, c) for c in ("doc_id", "n_shingles", "component"))
        blobs = asked.column("tokens").to_pylist()
        matrix = _Matrix(group.column("tokens").to_pylist())
        bound = matrix.bounds(blobs)
        least = np.array([_least_overlap(share, int(s), int(max(n[part == w].min(), -(-p * s // q)))) for s, w in zip(size, wanted)])
        chosen = np.flatnonzero(bound >= least)
        if not len(chosen):
            return _links([])
        overlaps = matrix.overlaps([blobs[i] for i in chosen])
        near = _alike(share, overlaps, size[chosen][:, None], n[None, :]) & (part[None, :] == wanted[chosen][:, None])
        # All members of one component in a group are connected: one link with it is enough.
        return _links([(int(query[i]), int(ids[np.argmax(row)])) for i, row in zip(chosen, near) if row.any()])

    keys = ["leader", "part", "turn"]
    return left.groupBy(keys).cogroup(right.groupBy(keys)).applyInArrow(opened, LINKS)
