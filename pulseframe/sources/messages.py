"""Sensor message streams."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def kafka_options(
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Reader options.

    `max_offsets_per_trigger` bounds a catch-up batch; `min_partitions` splits
    a topic partition that holds most of the backlog over several tasks.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def read_messages(
    spark: SparkSession, options: Mapping[str, str], source: str = "kafka"
) -> DataFrame:
    """A stream with a `value` column; Kafka's connector must be on the class path."""
    return spark.readStream.format(source).options(**options).load()
