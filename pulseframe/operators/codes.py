"""Item-code groups: text -> dimension table or Python lists."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.schemas import ITEM_CODE_TEXT


def code_lists(text: Mapping[str, str] = ITEM_CODE_TEXT) -> dict[str, list[int]]:
    """Comma-separated codes per vital sign -> lists, for CASE and IN."""
    return {name: [int(code) for code in codes.split(",")] for name, codes in text.items()}


def all_codes(groups: Mapping[str, list[int]]) -> list[int]:
    return [code for codes in groups.values() for code in codes]


def code_dimension(spark: SparkSession, text: Mapping[str, str] = ITEM_CODE_TEXT) -> DataFrame:
    """(itemid, measurement), one row per code; the first group to list a code keeps it.

    Its size is that of the settings text, never of the data, so it is safe to
    broadcast.
    """
    groups = F.array(
        *[F.struct(F.lit(n).alias("name"), F.lit(c).alias("codes")) for n, c in text.items()]
    )
    return (
        spark.range(0, 1, 1, 1)
        .select(F.posexplode(groups).alias("place", "spec"))
        .select("place", "spec.name", F.explode(F.split("spec.codes", ",")).alias("code"))
        .groupBy(F.trim("code").cast("int").alias("itemid"))
        .agg(F.min_by("name", "place").alias("measurement"))
    )


def known_codes(d_items: DataFrame, text: Mapping[str, str] = ITEM_CODE_TEXT) -> DataFrame:
    """(measurement, itemid, times): listed codes of the dictionary and how often each stands there; no more rows than the lists."""
    listed = d_items.where(F.col("itemid").isin(all_codes(code_lists(text)))).groupBy("itemid")
    return code_dimension(d_items.sparkSession, text).join(listed.agg(F.count(F.lit(1)).alias("times")), "itemid")
