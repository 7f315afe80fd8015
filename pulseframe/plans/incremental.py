"""The feature table kept up to date: only admissions with new readings are computed again."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.operators.codes import all_codes, code_lists
from pulseframe.operators.extract import stays, valid_readings
from pulseframe.operators.vitals import demographics
from pulseframe.schemas import CHARTEVENTS, ITEM_CODE_TEXT, ClinicalTables
from pulseframe.sinks.manifest import Manifest
from pulseframe.sources.bucketed import observations
from pulseframe.staging import stage

KEY = "hadm_id"
FEATURES = (
    "hadm_id long, charttime timestamp, systolic_bp double, diastolic_bp double, map double, heart_rate double, gender string, age double"
)
#: One entry for each partition that a version replaced; `part` -1 stands for the version itself.
VERSIONS = "version long, after long, upto long, part int, filled boolean"


@dataclass(frozen=True)
class Update:
    """What a call has done: nothing if `version` is None."""

    version: int | None
    upto: int | None
    parts: tuple[int, ...]


class FeatureStore:
    """Features in partitions by admission, in versions, and the readings they come from.

    An update reads the readings beyond the high-water mark from their source, once, and lands them. It computes the
    admissions that they touch from all landed readings of these, and writes new versions of the partitions where such admissions
    lie; the other partitions stay as they are. The mark and the new versions become visible together, by one
    manifest file; an update that dies before leaves folders that nobody reads, and the next one repeats it.

    The mark is a column of the readings that grows with their arrival, such as a sequence number or time of storage: a
    reading that arrives later with a smaller mark is not seen. `text`, the item dictionary and the demographics are
    those of the update that computes an admission.
    """

    def __init__(self, root: str, mark: str, partitions: int = 256, text: Mapping[str, str] = ITEM_CODE_TEXT):
        self._root, self._mark, self._partitions, self._text = root.rstrip("/"), mark, partitions, text
        self._versions = Manifest(f"{self._root}/versions", VERSIONS)

    def _part(self):
        return F.pmod(F.xxhash64(KEY), F.lit(self._partitions)).cast("int")

    def high_water(self, spark: SparkSession) -> tuple[int, int | None]:
        """The last version's number and mark; (0, None) before the first."""
        last = self._versions.entries(spark).agg(F.max(F.struct("version", "upto")).alias("last")).first()["last"]
        return (0, None) if last is None else (last["version"], last["upto"])

    def _landed(self, spark: SparkSession, versions: list[int], parts: list[int]) -> DataFrame:
        declared = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CHARTEVENTS.fields)
        reader = spark.read.schema(f"{declared}, version long, part int").option("basePath", f"{self._root}/readings")
        folders = [f"{self._root}/readings/version={v}" for v in versions]
        return reader.parquet(*folders).where(F.col("part").isin(parts))

    def update(self, tables: ClinicalTables, repeated: str = "all") -> Update:
        """Bring the features up to the readings in `tables.chartevents`, which have the mark as a further column."""
        spark = tables.chartevents.sparkSession
        number, low = self.high_water(spark)
        version = number + 1
        # Filters and mark reach the source's scan; only listed codes are kept.
        fresh = valid_readings(tables.chartevents, all_codes(code_lists(self._text)))
        fresh = fresh if low is None else fresh.where(F.col(self._mark) > low)
        landing = f"{self._root}/readings/version={version}"
        rows = fresh.select(*CHARTEVENTS.names, F.col(self._mark).cast("long").alias("_mark"), self._part().alias("part"))
        # Each task would write a file for every partition: rows of a partition meet, spread over a few tasks by their time.
        rows.repartition("part", F.pmod(F.xxhash64("charttime"), F.lit(8))).write.mode("overwrite").partitionBy("part").parquet(landing)
        landed = spark.read.schema(f"{KEY} long, _mark long, part int").option("basePath", landing).parquet(landing)
        upto = landed.agg(F.max("_mark")).first()[0]
        if upto is None:
            return Update(None, low, ())
        touched = stage(landed.select(KEY, "part").distinct(), "touched")
        parts = sorted(row["part"] for row in touched.select("part").distinct().collect())
        known = [row["version"] for row in self._versions.entries(spark).where("part = -1").select("version").distinct().collect()]
        mine = touched.select(KEY)
        readings = self._landed(spark, [*sorted(known), version], parts).join(mine, KEY, "left_semi")
        people = demographics(stays(tables), repeated).join(mine, KEY, "left_semi")
        computed = observations(readings, tables.d_items, self._text).join(people, KEY)
        before = self._read(spark, parts)
        kept = before.join(mine, KEY, "left_anti").select(computed.columns)
        folder = f"{self._root}/features/version={version}"
        replaced = computed.union(kept).withColumn("part", self._part())
        replaced.repartition("part", F.pmod(F.xxhash64("charttime"), F.lit(8))).write.mode("overwrite").partitionBy("part").parquet(folder)
        filled = {r["part"] for r in spark.read.schema("part int").option("basePath", folder).parquet(folder).select("part").distinct().collect()}
        self._versions.add(spark, [(version, low, upto, -1, False), *((version, low, upto, p, p in filled) for p in parts)])
        return Update(version, upto, tuple(parts))

    def paths(self, spark: SparkSession, parts: list[int] | None = None) -> list[str]:
        """The folder that holds each partition's rows now."""
        entries = self._versions.entries(spark).where("part >= 0")
        entries = entries if parts is None else entries.where(F.col("part").isin(parts))
        latest = entries.groupBy("part").agg(F.max(F.struct("version", "filled")).alias("last")).where("last.filled").collect()
        return sorted(f"{self._root}/features/version={row['last']['version']}/part={row['part']}" for row in latest)

    def _read(self, spark: SparkSession, parts: list[int] | None) -> DataFrame:
        paths = self.paths(spark, parts)
        return spark.read.schema(FEATURES).parquet(*paths) if paths else spark.createDataFrame([], FEATURES)

    def read(self, spark: SparkSession) -> DataFrame:
        """The features as of the last finished update."""
        return self._read(spark, None)
