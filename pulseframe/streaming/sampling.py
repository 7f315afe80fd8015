"""A training sample of a stream that grows better with every batch, however the batches are cut."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.operators.model import fit, sensor_pipeline
from pulseframe.operators.quality import split_complete
from pulseframe.operators.split import group_hash
from pulseframe.schemas import SENSOR_FEATURES, SENSOR_TARGETS
from pulseframe.sinks.manifest import Manifest
from pulseframe.streaming.scoring import StreamTraining

VERSIONS = "batch_id long, folder string, n_rows long, bound long"


class StreamSample:
    """The `size` rows of the smallest hash among all rows seen, kept as a table under `root`.

    Which rows these are depends on the rows alone: the sample of two samples is the sample of both. A batch moves only
    its rows below the largest hash that is kept, of each task at most `size`. Each batch's version is listed when it is
    complete; a batch that is listed already is not added again. Rows are hashed by `keys`, and equal rows count each.
    """

    def __init__(self, root: str, size: int, keys: Sequence[str], seed: int = 42):
        self._root, self._size, self._keys, self._seed = root.rstrip("/"), size, list(keys), seed
        self._versions = Manifest(f"{self._root}/versions", VERSIONS)

    def _latest(self, spark: SparkSession):
        return self._versions.entries(spark).agg(F.max(F.struct("batch_id", "folder", "n_rows", "bound")).alias("last")).first()["last"]

    def add(self, batch: DataFrame, batch_id: int) -> None:
        spark, last = batch.sparkSession, self._latest(batch.sparkSession)
        if last is not None and last["batch_id"] >= batch_id:
            return
        key = F.concat_ws("|", *[F.col(k).cast("string") for k in self._keys])
        rows = batch.withColumn("_hash", group_hash(key, self._seed))
        if last is not None:
            if last["n_rows"] >= self._size:
                rows = rows.where(F.col("_hash") <= last["bound"])
            rows = rows.union(spark.read.schema(rows.schema).parquet(f"{self._root}/{last['folder']}"))
        kept = rows.orderBy("_hash", *self._keys).limit(self._size)
        folder = f"rows-{batch_id}-{uuid.uuid4().hex}"
        kept.write.parquet(f"{self._root}/{folder}")
        n, bound = spark.read.schema("_hash long").parquet(f"{self._root}/{folder}").agg(F.count(F.lit(1)), F.max("_hash")).first()
        self._versions.add(spark, [(batch_id, folder, n, bound)])

    def count(self, spark: SparkSession) -> int:
        last = self._latest(spark)
        return 0 if last is None else last["n_rows"]

    def read(self, spark: SparkSession, schema: str) -> DataFrame:
        last = self._latest(spark)
        return spark.createDataFrame([], schema) if last is None else spark.read.schema(schema).parquet(f"{self._root}/{last['folder']}")


@dataclass(frozen=True)
class SampledTraining(StreamTraining):
    """Trains on a sample of the labelled readings of all batches so far, and not on one batch of them.

    Until `least_rows` are in the sample, usable readings wait, as with StreamTraining.
    """

    sample: StreamSample | None = None

    def see(self, usable: DataFrame, batch_id: int) -> None:
        labelled, _ = split_complete(usable, SENSOR_TARGETS)
        self.sample.add(labelled.select(*SENSOR_FEATURES, *SENSOR_TARGETS), batch_id)

    def model_from(self, usable: DataFrame) -> PipelineModel | None:
        spark = usable.sparkSession
        if self.sample.count(spark) < max(self.least_rows, 1):
            return None
        kinds = ", ".join(f"{name} {usable.schema[name].dataType.simpleString()}" for name in [*SENSOR_FEATURES, *SENSOR_TARGETS])
        return fit(sensor_pipeline(self.settings), self.sample.read(spark, kinds), self.settings)
