"""Hash buckets that any SQL engine with md5 can reproduce."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def portable_bucket(keys: Sequence[Column], seed: int, buckets: int) -> Column:
    """Bucket 0..buckets-1 from the keys' text and the seed alone.

    It does not depend on partitioning, row order or task retries, which a
    seeded random draw does.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[key.cast("string") for key in keys])
    leading_bits = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return leading_bits % F.lit(buckets)
