"""Questions about keys that documents share, answered without moving documents.

Documents are dealt into chunks of a few megabytes by a hash of their id. A chunk sends
each of its distinct keys once, as packed arrays, to the bucket of that key; a bucket sees
who else holds the key and sends one byte (or one id) per key back to the chunk. However
many documents share a key, a bucket gets one entry of it per chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 2 << 20
BUCKET_BYTES = 4 << 20

REQUEST = "chunk int, bucket int, keys binary, extra binary, owners binary"
REPLY = "chunk int, bucket int, flags binary"


@dataclass(frozen=True)
class Layout:
    """How many chunks and buckets; results do not depend on it."""

    chunks: int
    bucket_bits: int


def layout(docs: DataFrame, text: str = "text") -> Layout:
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("binary"))).alias("b")).first()["b"] or 0
    return Layout(max(1, -(-size // CHUNK_BYTES)), max(3, int(size // BUCKET_BYTES).bit_length()))


def chunked(docs: DataFrame, plan: Layout, id_column: str = "doc_id", text: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """(chunk, doc_id, text) of every row with an id, and a struct `rest` of the columns to carry, if any."""
    rest = [F.struct(*(F.col(c) for c in carry)).alias("rest")] if carry else []
    key = F.col(id_column)
    return docs.where(key.isNotNull()).select(
        F.pmod(F.xxhash64(key), F.lit(plan.chunks)).cast("int").alias("chunk"),
        key.cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        *rest,
    )


def column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().to_numpy(zero_copy_only=False)


def in_order(table: pa.Table) -> pa.Table:
    """A chunk's rows by id and text: the same order whenever the chunk is read again."""
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def bucket_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _cuts(buckets: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.flatnonzero(np.diff(buckets)) + 1, [len(buckets)]]) if len(buckets) else np.zeros(1, np.int64)


def distinct(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct 64-bit keys in order, the place of each key among them, and how often each occurs."""
    if not len(keys):
        return keys, np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.argsort(keys)
    ordered = keys[order]
    fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    number = np.cumsum(fresh) - 1
    place = np.empty(len(keys), np.int64)
    place[order] = number
    return ordered[fresh], place, np.bincount(number)


def _requests(chunk: int, buckets, parts: list[tuple[bytes, bytes, bytes]]) -> pa.Table:
    return pa.table(
        {
            "chunk": pa.array([chunk] * len(parts), pa.int32()),
            "bucket": pa.array(buckets, pa.int32()),
            "keys": pa.array([p[0] for p in parts], pa.binary()),
            "extra": pa.array([p[1] for p in parts], pa.binary()),
            "owners": pa.array([p[2] for p in parts], pa.binary()),
        }
    )


def count_request(chunk: int, keys: np.ndarray, counts: np.ndarray, bits: int) -> pa.Table:
    """For distinct ordered 64-bit keys: 32 bits beyond the bucket of each, and its count here (255 at most)."""
    buckets = bucket_of(keys, bits)
    short = (keys >> np.uint64(32 - bits)).astype(np.uint32)
    counts = np.minimum(counts, 255).astype(np.uint8)
    cuts = _cuts(buckets)
    parts = [(short[a:b].tobytes(), counts[a:b].tobytes(), b"") for a, b in zip(cuts[:-1], cuts[1:])]
    return _requests(chunk, buckets[cuts[:-1]], parts)


def run_starts(ordered: np.ndarray) -> np.ndarray:
    fresh = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    return np.flatnonzero(fresh)


def reply_table(table: pa.Table, sizes: np.ndarray, flags: np.ndarray) -> pa.Table:
    ends = np.cumsum(sizes)
    return pa.table(
        {
            "chunk": table.column("chunk").combine_chunks(),
            "bucket": table.column("bucket").combine_chunks(),
            "flags": pa.array([flags[e - s : e].tobytes() for s, e in zip(sizes, ends)], pa.binary()),
        }
    )


def count_reply(table: pa.Table) -> pa.Table:
    """One byte a key: in how many places it occurs, exact to 15, then 8 steps to each doubling."""
    blobs = table.column("keys").to_pylist()
    keys = np.concatenate([np.frombuffer(b, np.uint32) for b in blobs])
    counts = np.concatenate([np.frombuffer(b, np.uint8) for b in table.column("extra").to_pylist()]).astype(np.int64)
    order = np.argsort(keys, kind="stable")
    at = run_starts(keys[order])
    totals = np.add.reduceat(counts[order], at)
    level = np.where(totals < 16, totals, 16 + 8 * (np.log2(np.maximum(totals, 1)) - 4)).astype(np.int64)
    level = np.minimum(level, 255).astype(np.uint8)
    flags = np.empty(len(keys), np.uint8)
    flags[order] = np.repeat(level, np.diff(np.concatenate([at, [len(keys)]])))
    return reply_table(table, np.array([len(b) // 4 for b in blobs]), flags)


def owner_request(chunk: int, keys: np.ndarray, second: np.ndarray, owners: np.ndarray, extra: np.ndarray, bits: int):
    """For distinct keys: the key, its smallest owner here and something extra.

    `second` is an independent hash of the same content; it names the bucket, so that two
    contents are taken for one only if 64 bits and the bucket agree. Returns the order in which
    the answers come, and the requests.
    """
    buckets = bucket_of(second, bits)
    order = np.argsort(buckets, kind="stable")
    buckets, keys, owners, extra = buckets[order], keys[order], owners[order], extra[order]
    cuts = _cuts(buckets)
    parts = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        names, index = np.unique(owners[a:b], return_inverse=True)
        wide = np.uint16 if len(names) < 1 << 16 else np.uint32
        head = np.array([len(names)], np.int64)
        parts.append(
            (keys[a:b].tobytes(), extra[a:b].tobytes(), head.tobytes() + names.astype(np.int64).tobytes() + index.astype(wide).tobytes())
        )
    return order, _requests(chunk, buckets[cuts[:-1]], parts)


def _owners(blob: bytes) -> np.ndarray:
    n = int(np.frombuffer(blob, np.int64, 1)[0])
    names = np.frombuffer(blob, np.int64, n, 8)
    return names[np.frombuffer(blob, np.uint16 if n < 1 << 16 else np.uint32, -1, 8 + 8 * n)]


def smallest(table: pa.Table):
    blobs = table.column("keys").to_pylist()
    keys = np.concatenate([np.frombuffer(b, np.uint64) for b in blobs])
    owners = np.concatenate([_owners(b) for b in table.column("owners").to_pylist()])
    order = np.argsort(keys, kind="stable")
    at = run_starts(keys[order])
    spread = np.diff(np.concatenate([at, [len(keys)]]))
    least = np.empty(len(keys), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(owners[order], at), spread)
    return keys, owners, order, at, spread, least, np.array([len(b) // 8 for b in blobs])


def earlier_reply(table: pa.Table) -> pa.Table:
    """One byte a key: 1 if another chunk has a smaller owner of it."""
    _, owners, _, _, _, least, sizes = smallest(table)
    return reply_table(table, sizes, (least < owners).astype(np.uint8))


def holder_reply(table: pa.Table) -> pa.Table:
    """Nine bytes a key: its smallest owner anywhere, and its count (255 at most)."""
    keys, _, order, at, spread, least, sizes = smallest(table)
    counts = np.concatenate([np.frombuffer(b, np.uint8) for b in table.column("extra").to_pylist()]).astype(np.int64)
    totals = np.empty(len(keys), np.int64)
    totals[order] = np.repeat(np.add.reduceat(counts[order], at), spread)
    answer = np.empty(len(keys), np.dtype([("owner", "<i8"), ("count", "u1")]))
    answer["owner"], answer["count"] = least, np.minimum(totals, 255)
    return reply_table(table, sizes, answer)


def answers(table: pa.Table, dtype=np.uint8) -> np.ndarray:
    """All replies to a chunk, in the order of its requests."""
    if not table.num_rows:
        return np.empty(0, dtype)
    order = np.argsort(column(table, "bucket"), kind="stable")
    blobs = table.column("flags").to_pylist()
    return np.concatenate([np.frombuffer(blobs[i], dtype) for i in order])


def ask(chunks: DataFrame, request: Callable[[pa.Table], pa.Table], reply: Callable[[pa.Table], pa.Table], replies: DataFrame | None = None) -> DataFrame:
    """The replies to what every chunk requests; `replies` of an earlier question go to `request` too."""
    asked = together(chunks, replies, request, REQUEST)
    return asked.groupBy("bucket").applyInArrow(reply, REPLY)


def together(chunks: DataFrame, replies: DataFrame | None, work: Callable[..., pa.Table], schema: str) -> DataFrame:
    """`work` on every chunk, with the replies it got."""
    if replies is None:
        return chunks.groupBy("chunk").applyInArrow(work, schema)
    return chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(work, schema)


@dataclass(frozen=True)
class Claims:
    """Distinct keys of a chunk in the order of its requests to the owners' buckets."""

    table: pa.Table
    place: np.ndarray  # of each given key among the requests
    owners: np.ndarray  # smallest owner here, by request


def claims(chunk: int, keys: np.ndarray, second: np.ndarray, owners: np.ndarray, bits: int, extra: np.ndarray | None = None) -> Claims:
    """Requests for the smallest owner of each key; `owners` has one id for each key given.

    `extra` goes along, the same for equal keys; by default it is how often the key occurs (255 at most).
    """
    uniq, place, counts = distinct(keys, bits)
    least = np.full(len(uniq), np.iinfo(np.int64).max, np.int64)
    np.minimum.at(least, place, owners)
    other = np.empty(len(uniq), np.uint64)
    other[place] = second
    if extra is None:
        along = np.minimum(counts, 255).astype(np.uint8)
    else:
        along = np.empty(len(uniq), extra.dtype)
        along[place] = extra
    order, table = owner_request(chunk, uniq, other, least, along, bits)
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    return Claims(table, back[place] if len(place) else place, least[order])


def next_question(replies: DataFrame, bits: int, number: int) -> DataFrame:
    """Replies to a later question, told apart from earlier ones by their bucket."""
    return replies.withColumn("bucket", F.col("bucket") + F.lit(number << bits))


def question(table: pa.Table, bits: int, number: int) -> pa.Table:
    """The replies to one question of several."""
    return table.filter(pa.array((column(table, "bucket") >> bits) == number)) if table.num_rows else table
