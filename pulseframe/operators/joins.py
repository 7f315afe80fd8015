"""Equi-joins of a large fact side with a keyed dimension side.

Three physical forms, chosen from measured facts and all giving the same rows:

1. the dimension is small (checked against Catalyst's size estimate): broadcast
   it, so the fact side does not move and key skew cannot matter;
2. the dimension is large and no key is hot: a plain shuffled join, left to
   Catalyst and AQE;
3. some keys are hot: their fact rows are spread over several salts and only
   their dimension rows are repeated, once per salt.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.staging import stage

# Compressed file bytes, which may be a few times as many in memory.
BROADCAST_BYTES = 16 << 20
# What one task should read of a joined table at most.
TASK_BYTES = 256 << 20
# Hot keys that reach the driver and are broadcast; the sketch tracks eight times as many.
MOST_HOT_KEYS = 100_000
SKETCH_GROUPS = 256
ROW = "_row"


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan; runs no job."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(stats.sizeInBytes())


def fits_broadcast(frames: Sequence[DataFrame], limit: int = BROADCAST_BYTES) -> bool:
    return sum(estimated_bytes(frame) for frame in frames) <= limit


def is_unique(table: DataFrame, key: str) -> bool:
    repeated = table.groupBy(key).count().where(F.col("count") > 1)
    return repeated.isEmpty()


def numbered(table: DataFrame) -> DataFrame:
    """Adds a row number for `spread_by`, so that even exact copies are spread.

    For tables read from files: a retried task gives the same rows the same
    numbers. A shuffle or a database may deliver them in another order. Where
    no join ends up salted, the optimizer drops the column.
    """
    return table.withColumn(ROW, F.monotonically_increasing_id())


def hot_share(df: DataFrame, task_bytes: int = TASK_BYTES) -> float:
    """The share of the rows from which a key alone overfills a task.

    That of one shuffle partition or of `task_bytes`, whichever is less. Keys below 1/MOST_HOT_KEYS are
    left to AQE's splitting of skewed partitions.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = min(1.0 / partitions, task_bytes / max(estimated_bytes(df), 1))
    return max(share, 1.0 / MOST_HOT_KEYS)


def frequent_keys_of(
    df: DataFrame, keys: Sequence[str], task_bytes: int = TASK_BYTES
) -> dict[str, dict]:
    """For each key column: keys that alone would overfill a task -> share of the rows.

    One pass for all of them. Frequent-items sketches are built map-side and merged in two levels, so the
    keys are never shuffled. At most 1/share keys can hold that share, which
    bounds what reaches the driver whatever the input size (MOST_HOT_KEYS entries).
    """
    share = hot_share(df, task_bytes)
    most = math.ceil(1.0 / share)
    tracked = 8 * most
    group = "_sketch_group"
    local = (
        df.select(*keys)
        .withColumn(group, F.spark_partition_id() % SKETCH_GROUPS)
        .groupBy(group)
        .agg(
            *(F.expr(f"approx_top_k_accumulate(`{k}`, {tracked})").alias(f"sketch_{i}") for i, k in enumerate(keys)),
            *(F.count(k).alias(f"rows_{i}") for i, k in enumerate(keys)),
        )
    )
    # Grouping by a constant leaves an empty input empty: there is no sketch to merge.
    merged = local.groupBy(F.lit(1).alias("all")).agg(
        *(F.expr(f"approx_top_k_combine(sketch_{i}, {tracked})").alias(f"sketch_{i}") for i in range(len(keys))),
        *(F.sum(f"rows_{i}").alias(f"rows_{i}") for i in range(len(keys))),
    )
    tops = [F.expr(f"approx_top_k_estimate(sketch_{i}, {most})").alias(f"top_{i}") for i in range(len(keys))]
    found: dict[str, dict] = {k: {} for k in keys}
    for row in merged.select(*tops, *(f"rows_{i}" for i in range(len(keys)))).collect():
        for i, k in enumerate(keys):
            rows = row[f"rows_{i}"]
            found[k] = {
                t["item"]: t["count"] / rows
                for t in row[f"top_{i}"]
                if t["item"] is not None and t["count"] > share * rows
            }
    return found


def frequent_keys(df: DataFrame, key: str, task_bytes: int = TASK_BYTES) -> dict:
    return frequent_keys_of(df, [key], task_bytes)[key]


def join_by_key(
    facts: DataFrame,
    dims: DataFrame,
    key: str,
    *,
    spread_by: Sequence[str],
    small: bool | None = None,
    hot: Mapping | None = None,
    stage_facts: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Inner join on `key`.

    `small`: whether `dims` may be broadcast, where the caller knows a better
    bound than Catalyst, which multiplies the sizes of joined tables. `hot`: hot keys of `facts`, where
    the caller has counted them; otherwise they are looked for in `facts` itself. `stage_facts`: write
    `facts` first, if they are costly to compute and not large. `spread_by`:
    fact columns that differ within a hot key, or the number from `numbered`;
    hashing them (instead of drawing at random) keeps a retried task's rows
    where they were.
    """
    if small is None:
        small = fits_broadcast([dims], broadcast_bytes)
    if small:
        return facts.join(F.broadcast(dims), key)
    if stage_facts:
        facts = stage(facts, "facts")
    if hot is None:
        hot = frequent_keys(facts, key)
    if not hot:
        return facts.join(dims, key)
    return _salted_join(facts, dims, key, spread_by, hot)


def _salted_join(facts, dims, key, spread_by, hot):
    spark = facts.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = [(k, math.ceil(2 * share * partitions)) for k, share in hot.items()]
    key_type = facts.schema[key].dataType.simpleString()
    # At most MOST_HOT_KEYS rows: see hot_share.
    salts = F.broadcast(spark.createDataFrame(rows, f"`{key}` {key_type}, _salts int"))
    many = F.coalesce("_salts", F.lit(1))
    spread = facts.join(salts, key, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*spread_by), many).cast("int")
    )
    repeated = dims.join(salts, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), many - 1))
    )
    return spread.drop("_salts").join(repeated.drop("_salts"), [key, "_salt"]).drop("_salt")
