"""Lists of what has been committed: readers follow the list, so a half-written folder is never seen."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from pulseframe.staging import exists, remove


class Manifest:
    """Entries of a fixed schema under a folder, each set of them added by one file that appears at once or not at all.

    Entries are only ever added. Whoever reads them decides which one counts where several say the same.
    """

    def __init__(self, root: str, schema: str):
        self._root, self._schema = root.rstrip("/"), schema

    def add(self, spark: SparkSession, rows: list[tuple]) -> None:
        entry = spark.createDataFrame(rows, self._schema).coalesce(1)
        entry.write.parquet(f"{self._root}/{uuid.uuid4().hex}")

    def entries(self, spark: SparkSession) -> DataFrame:
        if not exists(spark, self._root):
            return spark.createDataFrame([], self._schema)
        return spark.read.schema(self._schema).option("recursiveFileLookup", "true").parquet(self._root)

    def compact(self, spark: SparkSession) -> None:
        """Write all entries to one file, then drop the files they came from; meanwhile some are listed twice."""
        files = sorted(self.entries(spark).inputFiles())
        if len(files) < 2:
            return
        rows = [tuple(row) for row in self.entries(spark).distinct().collect()]
        self.add(spark, rows)
        for folder in {file.rsplit("/", 1)[0] for file in files}:
            remove(spark, folder)
