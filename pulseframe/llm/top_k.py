"""Exact top-k inner products from an impact-ordered index, score at a time.

A component of a vector is a posting: its vector under a dimension. The index holds, block by
block of vectors, the postings in segments of falling quantised impact (the magnitude's power of
two). A query adds up segment after segment of a block for all its vectors. Beside each partial
score stands a bound on what the segments still to come can add. A block's scan stops when the
bound proves that no more than the wanted vectors, and ties, can be among the best k; those are
scored exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulseframe.llm import exchange
from pulseframe.staging import stage

#: Vectors of an index block, and queries that meet it in one task.
BLOCK_VECTORS = 4096
QUERIES_TOGETHER = 4096

#: Whole numbers below this are exact in double arithmetic.
EXACT = 1 << 53

SEGMENTS = "block int, dims int, ids binary, levels array<int>, postings array<binary>"
SCORES = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, scale: int, id_column: str, vector: str) -> DataFrame:
    """(vec_id, v): components as floor(scale * x) of vectors whose components are all finite numbers."""
    number = F.col(vector).cast("array<double>")
    usable = F.col(id_column).isNotNull() & F.col(vector).isNotNull() & F.forall(
        number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return vectors.where(usable).select(
        F.col(id_column).cast("long").alias("vec_id"), F.transform(number, lambda x: F.floor(x * scale).cast("long")).alias("v")
    )


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), dims).astype(np.int64)


def _segments(block: int, dims: int, ids: np.ndarray, values: np.ndarray) -> pa.Table:
    """Postings (vector, dimension, value) of a block by falling power of two of their magnitude."""
    level = np.zeros(values.shape, np.int64)
    filled = values != 0
    level[filled] = np.frexp(np.abs(values[filled].astype(np.float64)))[1]  # magnitude < 2**level, or about that beyond 2**53
    rows, columns = np.nonzero(filled)
    flat, size = level[filled], values[filled].astype(np.int64)
    levels = np.unique(flat)[::-1]
    postings = []
    for at in levels:
        chosen = flat == at
        postings.append(rows[chosen].astype(np.int32).tobytes() + columns[chosen].astype(np.int32).tobytes() + size[chosen].tobytes())
    return pa.table(
        {
            "block": pa.array([block], pa.int32()),
            "dims": pa.array([dims], pa.int32()),
            "ids": pa.array([ids.astype(np.int64).tobytes()], pa.binary()),
            "levels": pa.array([levels.tolist()], pa.list_(pa.int32())),
            "postings": pa.array([postings], pa.list_(pa.binary())),
        }
    )


def _largest(values: np.ndarray) -> int:
    return max(abs(int(values.min())), abs(int(values.max()))) if values.size else 0


def _best_of_all(ids: np.ndarray, postings: list[bytes], names: np.ndarray, queries: np.ndarray, k: int):
    """As _best for components so large that double arithmetic is not exact: whole numbers of any size, all scores."""
    whole = np.zeros((len(ids), queries.shape[1]), object)
    for blob in postings:
        m = len(blob) // 16
        whole[np.frombuffer(blob, np.int32, m), np.frombuffer(blob, np.int32, m, 4 * m)] = np.frombuffer(blob, np.int64, m, 8 * m).astype(object)
    found = []
    for name, query in zip(names, queries.astype(object)):
        members = np.flatnonzero(ids != name)
        exact = whole[members] @ query
        order = sorted(range(len(members)), key=lambda i: (-exact[i], ids[members[i]]))[:k]
        if any(not -(1 << 63) <= exact[i] < 1 << 63 for i in order):
            raise OverflowError("a score passes 64 bits")
        found.append((np.full(len(order), name), ids[members[order]], np.array([exact[i] for i in order], np.int64)))
    return found


def _best(ids: np.ndarray, levels: list[int], postings: list[bytes], names: np.ndarray, queries: np.ndarray, k: int):
    """(query, vector, score) of the k best of a block for every query, ties to smaller ids."""
    n, dims = len(ids), queries.shape[1]
    whole = np.zeros((n, dims))
    scores = np.zeros((len(queries), n))
    # What dimensions without a posting so far can add: magnitude below 2**level each.
    weight = np.abs(queries)
    unseen = np.ones((n, dims))
    open_ = np.arange(len(queries))
    keep: dict[int, np.ndarray] = {}
    # A query's own vectors may be among the best.
    own = int(max((ids == name).sum() for name in names))
    kth = min(k + own, n) - 1
    for step, (level, blob) in enumerate(zip(levels, postings)):
        m = len(blob) // 16
        rows, columns = np.frombuffer(blob, np.int32, m), np.frombuffer(blob, np.int32, m, 4 * m)
        values = np.frombuffer(blob, np.int64, m, 8 * m)
        segment = np.zeros((n, dims))
        segment[rows, columns] = values
        whole[rows, columns] = values
        unseen[rows, columns] = 0
        scores[open_] += queries[open_] @ segment.T
        following = float(2 ** levels[step + 1] - 1) if step + 1 < len(levels) else 0.0
        rest = (weight[open_] @ unseen.T) * following
        lower = scores[open_] - rest
        least = -np.partition(-lower, kth, axis=1)[:, kth]
        possible = scores[open_] + rest >= least[:, None]
        few = possible.sum(axis=1) <= max(4 * k, kth + 1)
        if following == 0.0:
            few[:] = True
        for at in np.flatnonzero(few):
            keep[int(open_[at])] = np.flatnonzero(possible[at])
        open_ = open_[~few]
        if not len(open_):
            break
    for at in open_:  # no component of the block differs from 0
        keep[int(at)] = np.arange(n)
    # The proof's members need every component: segments not read yet are filled in.
    for blob in postings[step + 1 :] if len(levels) else []:
        m = len(blob) // 16
        whole[np.frombuffer(blob, np.int32, m), np.frombuffer(blob, np.int32, m, 4 * m)] = np.frombuffer(blob, np.int64, m, 8 * m)
    found = []
    for at, members in keep.items():
        exact = np.rint(whole[members] @ queries[at]).astype(np.int64)
        other = ids[members] != names[at]
        members, exact = members[other], exact[other]
        order = np.lexsort((ids[members], -exact))[:k]
        found.append((np.full(len(order), names[at]), ids[members[order]], exact[order]))
    return found


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 10, scale: int = 1024, id_column: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other vectors of every query by integer inner product.

    Components become floor(scale * x), and scores are exact; one beyond 64 bits raises. Ties go to the smaller vec_id; fewer than k rows
    come only where there are fewer other vectors. A vector that is null or has a null or
    non-finite component takes no part, as query or candidate; nor does one without an id. Vectors are
    compared with those of equal length. A query's own id is no candidate. Rows that repeat an id
    count each, as candidates and as queries. Other columns are ignored. Empty tables give no rows.
    """
    index = quantised(vectors, scale, id_column, vector)
    count = index.count()
    blocks = max(1, -(-count // BLOCK_VECTORS))
    dealt = index.select("vec_id", "v", F.size("v").alias("dims"), F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(blocks)).cast("int").alias("block"))

    def segments(table: pa.Table) -> pa.Table:
        dims, block = int(table.column("dims")[0].as_py()), int(table.column("block")[0].as_py())
        table = table.sort_by("vec_id")
        return _segments(block, dims, exchange.column(table, "vec_id"), _matrix(table.column("v"), dims))

    built = stage(dealt.groupBy("block", "dims").applyInArrow(segments, SEGMENTS), "impact-index")
    asked = quantised(queries, scale, id_column, vector)
    turns = max(1, -(-asked.count() // QUERIES_TOGETHER))
    turn = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(turns)).cast("int")
    # Every block of queries meets every block of the index: the stated queries against all rows.
    every = F.explode(F.sequence(F.lit(0), F.lit(turns - 1))).alias("turn")
    left = built.select("block", "dims", "ids", "levels", "postings", every)
    right = asked.select("vec_id", "v", F.size("v").alias("dims"), turn.alias("turn"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def search(block: pa.Table, mine: pa.Table) -> pa.Table:
        found = []
        if block.num_rows and mine.num_rows:
            dims = int(block.column("dims")[0].as_py())
            names, wanted = exchange.column(mine, "vec_id"), _matrix(mine.column("v"), dims)
            ids = np.frombuffer(block.column("ids")[0].as_py(), np.int64)
            levels, postings = block.column("levels")[0].as_py(), block.column("postings")[0].as_py()
            largest = max((_largest(np.frombuffer(b, np.int64, -1, len(b) // 2)) for b in postings), default=0)
            exact = dims * largest * _largest(wanted) < EXACT
            for at in range(0, len(names), 256):
                if not exact:
                    found += _best_of_all(ids, postings, names[at : at + 256], wanted[at : at + 256], k)
                    continue
                found += _best(ids, levels, postings, names[at : at + 256], wanted[at : at + 256].astype(np.float64), k)
        join = lambda i: np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64)
        return pa.table({"query_id": pa.array(join(0), pa.int64()), "vec_id": pa.array(join(1), pa.int64()), "score": pa.array(join(2), pa.int64())})

    keys = ["block", "turn", "dims"]
    partial = left.groupBy(keys).cogroup(right.groupBy(keys)).applyInArrow(search, SCORES)
    # Each task keeps its own k best of a query before the rows move.
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = partial.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
