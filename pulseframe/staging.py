"""Shared scratch space and tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.storagelevel import StorageLevel

from pulseframe.schemas import ClinicalTables

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Temporary folders of local-mode sessions, by application.
_local_roots: dict[str, str] = {}


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new path under the folder the cluster shares between its machines.

    Only a local-mode session may fall back to a temporary folder: on a cluster
    such a folder would exist on one machine only.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
        root = _local_roots.get(context.applicationId)
        if root is None:
            root = _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="pulseframe-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` once as Parquet and return a reader over the written table.

    Iterative consumers (forest training, several reports over one feature
    table) then re-read a narrow columnar table, and a lost executor costs a
    re-read instead of the joins and shuffles above it.
    """
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_bucketed(df: DataFrame, key: str, buckets: int, purpose: str) -> DataFrame:
    """As `stage`, in buckets by `key`: joins and groups by the key then read the rows where they lie, without a shuffle.

    The table has a name in the session's catalog; its files lie in the folder for work, like those of `stage`.
    """
    spark, path = df.sparkSession, work_dir(df.sparkSession, purpose)
    name = f"bucketed_{uuid.uuid4().hex}"
    # Each task writes the one bucket that its partition is.
    placed = df.repartition(buckets, key)
    placed.write.format("parquet").option("path", path).bucketBy(buckets, key).saveAsTable(name)
    return spark.table(name)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in whatever file system it is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, in whatever file system it is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def staged(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """As `stage`, but what was written is deleted when the block ends."""
    spark, path = df.sparkSession, work_dir(df.sparkSession, purpose)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)


@contextmanager
def persisted(df: DataFrame) -> Iterator[DataFrame]:
    """`df` kept in the executors' memory or on their disks until the block ends.

    One that the caller persisted already stays as it is.
    """
    if df.storageLevel.useMemory or df.storageLevel.useDisk:
        yield df
        return
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def land(tables: ClinicalTables) -> ClinicalTables:
    """Stage all four tables.

    For sources that are costly to read or of unknown size, such as a database:
    it is read once, and the joins then know which tables are small. Narrow the
    readings first; the filters travel to the source.
    """
    return ClinicalTables(
        stage(tables.patients, "patients"),
        stage(tables.admissions, "admissions"),
        stage(tables.chartevents, "chartevents"),
        stage(tables.d_items, "d-items"),
    )
