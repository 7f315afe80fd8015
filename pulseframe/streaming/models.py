"""Where a stream finds, or leaves, its trained model."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from pulseframe.operators.model import load_model, save_model


class ModelStore:
    """Model versions, each in a folder of its own, and a table that names the published ones.

    A version is named only after it is complete, so a job that dies while saving leaves an unnamed
    folder that nobody loads, and the version before stays as it was.
    """

    def __init__(self, path: str):
        self._path = path
        self._published = f"{path}/published"

    def latest(self, spark: SparkSession) -> tuple[int, str] | None:
        """Number and folder of the version published last."""
        try:
            versions = spark.read.schema("version long, folder string").parquet(self._published)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        row = versions.agg(F.max(F.struct("version", "folder")).alias("last")).first()
        return None if row is None or row["last"] is None else tuple(row["last"])

    def load(self, version: tuple[int, str]) -> PipelineModel:
        return load_model(f"{self._path}/{version[1]}")

    def find(self, spark: SparkSession) -> PipelineModel | None:
        version = self.latest(spark)
        return None if version is None else self.load(version)

    def publish(self, spark: SparkSession, model: PipelineModel) -> None:
        last = self.latest(spark)
        number = 1 if last is None else last[0] + 1
        folder = f"model-{number}-{uuid.uuid4().hex}"
        save_model(model, f"{self._path}/{folder}")
        named = spark.createDataFrame([(number, folder)], "version long, folder string")
        named.coalesce(1).write.mode("append").parquet(self._published)
