"""Writers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.schemas import BATCH_LABEL
from pulseframe.sinks.manifest import Manifest

# Fixed value: header of the label column in the predictions file.
LABEL_HEADER = "Systolic BP"


def single_task(df: DataFrame) -> DataFrame:
    """All rows in one partition, after the steps above have run in their own tasks.

    coalesce(1) would pull those steps, joins and aggregates too, into the one task.
    """
    return df.repartition(1)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Header, overwrite. `single_file` sends all rows through one task, which only writes them."""
    (single_task(df) if single_file else df).write.csv(path, header=True, mode="overwrite")


def write_predictions(predictions: DataFrame, path: str, single_file: bool = False) -> None:
    """Label and prediction of each scored observation."""
    pair = predictions.select(predictions[BATCH_LABEL].alias(LABEL_HEADER), "prediction")
    write_csv(pair, path, single_file)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """One micro-batch into its own folder. Writing a batch again replaces it,
    so a replay after a failure adds no rows."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All micro-batches written under `path`, with their batch_id."""
    return spark.read.schema(f"{schema}, batch_id long").option("basePath", path).parquet(path)


COMMITS = "batch_id long, folder string"


def _commits(path: str) -> Manifest:
    return Manifest(f"{path.rstrip('/')}/commits", COMMITS)


def commit_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """One micro-batch into a new folder, which readers see once it is complete and listed.

    A batch that is listed already is left as it is, so a replay neither adds nor takes away rows, whenever it is
    interrupted. Of two writers of one batch the reader takes one.
    """
    spark, commits = df.sparkSession, _commits(path)
    if not commits.entries(spark).where(F.col("batch_id") == batch_id).isEmpty():
        return
    folder = f"batch-{batch_id}-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/data/{folder}")
    commits.add(spark, [(batch_id, folder)])


def read_committed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All committed micro-batches under `path`, with their batch_id. Folders that are not listed are not read.

    The list has one short row for each batch; compact_commits keeps it in one file.
    """
    listed = _commits(path).entries(spark).groupBy("batch_id").agg(F.min("folder").alias("folder")).collect()
    if not listed:
        return spark.createDataFrame([], f"{schema}, batch_id long")
    rows = spark.read.schema(schema).parquet(*(f"{path}/data/{row['folder']}" for row in listed))
    number = F.regexp_extract(F.col("_metadata.file_path"), "/batch-(-?[0-9]+)-[0-9a-f]+/[^/]*$", 1)
    return rows.select("*", number.cast("long").alias("batch_id"))


def compact_commits(spark: SparkSession, path: str) -> None:
    _commits(path).compact(spark)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """A few rows for display, as a DataFrame; sort first if they must be particular ones."""
    return df.limit(n)
