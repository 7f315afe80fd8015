"""Train/test splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions import portable_bucket
from pulseframe.operators.extract import key_at
from pulseframe.staging import stage

SPLIT_BUCKETS = 10_000


def in_training_part(
    df: DataFrame, keys: Sequence[str], train_ratio: float = 0.8, seed: int = 42
) -> Column:
    """Deterministic membership from the row's key.

    Timestamps enter as epoch microseconds, so the session time zone does not
    matter.
    """
    columns = [
        F.unix_micros(F.col(key)) if df.schema[key].dataType.typeName() == "timestamp" else F.col(key)
        for key in keys
    ]
    return portable_bucket(columns, seed, SPLIT_BUCKETS) < round(train_ratio * SPLIT_BUCKETS)


def key_split(
    df: DataFrame, keys: Sequence[str], train_ratio: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, test): disjoint, complete, and the same however the data is partitioned."""
    chosen = in_training_part(df, keys, train_ratio, seed)
    return df.where(chosen), df.where(~chosen)


def random_split(
    df: DataFrame, train_ratio: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Seeded Bernoulli split. Depends on partitioning; prefer key_split for reruns."""
    train, test = df.randomSplit([train_ratio, 1.0 - train_ratio], seed=seed)
    return train, test


def group_hash(group: Column, seed: int) -> Column:
    """A 60-bit number from the group's text and the seed, which any SQL engine with md5 can reproduce."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), group.cast("string"))), 1, 15), 16, 10).cast("bigint")


def grouped_split(
    df: DataFrame, group: str, train_ratio: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with all rows of a group on one side and exactly the nearest whole number of groups in train.

    Groups are ordered by hash; the last hash of the training part is found by counting ranges of hashes, so nothing is
    sorted and only counts reach the driver. Groups of equal hash are told apart by their names. Rows
    without a group go to train.
    """
    hashed = F.col("_hash")
    groups = stage(df.select(group).where(F.col(group).isNotNull()).distinct().withColumn("_hash", group_hash(F.col(group), seed)), "groups")
    wanted = int(train_ratio * groups.count() + 0.5)
    key, below = key_at(groups.groupBy("_hash").agg(F.count(F.lit(1)).alias("n")), "_hash", wanted) if wanted else (-1, 0)
    # Of the groups with the last hash, most often one, as many as are still wanted.
    last = [row[0] for row in groups.where(hashed == key).orderBy(group).limit(wanted - below).select(group).collect()]
    inside = F.coalesce((group_hash(F.col(group), seed) < key) | F.col(group).isin(last), F.lit(True))
    return df.where(inside), df.where(~inside)
