"""Connected components by rounds of joins; nothing of the graph meets on one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.staging import stage


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in the links (a, b); component is the smallest id reachable.

    Each round an id and its present label take the smallest label among their neighbours, then
    labels are followed one step. Rounds end when no label changes. Every round's table is written
    to the shared folder, so a lost executor costs a read.
    """
    both = links.select("a", "b").where("a <> b")
    both = stage(both.union(both.select("b", "a")).distinct(), "links")
    labels = stage(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")).withColumnRenamed("a", "id"), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        offered = labels.join(near.withColumnRenamed("a", "id"), "id")
        offers = offered.select("id", F.least("label", "near").alias("label")).union(
            offered.where("near < label").select(F.col("label").alias("id"), F.col("near").alias("label"))
        )
        hooked = offers.groupBy("id").agg(F.min("label").alias("label"))
        up = hooked.select(F.col("id").alias("label"), F.col("label").alias("above"))
        followed = hooked.join(up, "label").select("id", F.least("label", "above").alias("label"))
        fresh = stage(followed, "labels")
        changed = fresh.join(labels.withColumnRenamed("label", "old"), "id").where("label <> old").limit(1).count()
        labels = fresh
        if not changed:
            return labels.withColumnRenamed("label", "component")
