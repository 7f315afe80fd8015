"""Readings and stays landed in buckets by admission, so that later jobs need not move them.

Landing costs one shuffle. From then on the mean per observation, the distinct demographics and the join of both
find their rows in the bucket where they are. An admission that would overfill a bucket is kept apart, unbucketed: its
readings are summed task by task before they meet.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.operators.codes import all_codes, code_lists, known_codes
from pulseframe.operators.extract import stays, valid_readings
from pulseframe.operators.joins import TASK_BYTES, estimated_bytes, frequent_keys
from pulseframe.operators.vitals import complete_vitals, demographics, pivot_vitals
from pulseframe.schemas import ADMISSIONS, CHARTEVENTS, ITEM_CODE_TEXT, PATIENTS, ClinicalTables
from pulseframe.staging import remove, work_dir

KEY = "hadm_id"
# What a stay's row has of the admission and its patient.
STAY_COLUMNS = [KEY, "subject_id", "admittime", "dischtime", "gender", "dob", "dod"]
_TYPES = {f.name: f.dataType.simpleString() for schema in (PATIENTS, ADMISSIONS, CHARTEVENTS) for f in schema.fields}


@dataclass(frozen=True)
class BucketedTables:
    """`readings` and `stays` lie in as many buckets of hadm_id; `hot` has the readings of the admissions `hot_keys`."""

    readings: DataFrame
    hot: DataFrame
    hot_keys: DataFrame
    stays: DataFrame
    d_items: DataFrame
    buckets: int
    root: str


def _open(spark: SparkSession, root: str, part: str, columns: list[str], buckets: int) -> DataFrame:
    """A bucketed folder as a table of the session's catalog, under a name of its own."""
    name = f"{part}_{uuid.uuid4().hex}"
    declared = ", ".join(f"`{c}` {_TYPES[c]}" for c in columns)
    order = f"SORTED BY ({KEY}{', charttime' if 'charttime' in columns else ''})"
    spark.sql(f"CREATE TABLE {name} ({declared}) USING parquet CLUSTERED BY ({KEY}) {order} INTO {buckets} BUCKETS LOCATION '{root}/{part}'")
    return spark.table(name)


def _write(rows: DataFrame, root: str, part: str, columns: list[str], buckets: int) -> None:
    """Each task writes the one bucket that its partition is."""
    order = [KEY, *(["charttime"] if "charttime" in columns else [])]
    name = f"{part}_{uuid.uuid4().hex}"
    placed = rows.select(columns).repartition(buckets, KEY)
    placed.write.format("parquet").option("path", f"{root}/{part}").bucketBy(buckets, KEY).sortBy(*order).saveAsTable(name)
    # The files stay: tables with a path of their own are external.
    rows.sparkSession.sql(f"DROP TABLE {name}")


def land_bucketed(
    tables: ClinicalTables, root: str | None = None, buckets: int | None = None, bucket_bytes: int = TASK_BYTES
) -> BucketedTables:
    """Write the readings, and the admissions with their patients, in buckets by admission.

    `root` is a new folder, by default one under spark.checkpoint.dir; `open_bucketed` finds the tables there in a
    later session. `buckets` follows from the readings' size by default.
    """
    spark = tables.chartevents.sparkSession
    root = root or work_dir(spark, "bucketed")
    buckets = buckets or max(1, math.ceil(estimated_bytes(tables.chartevents) / bucket_bytes))
    hot = frequent_keys(tables.chartevents.select(KEY), KEY, bucket_bytes)
    keys = spark.createDataFrame([(k,) for k in hot], f"{KEY} long")
    keys.coalesce(1).write.parquet(f"{root}/hot-keys")
    names = CHARTEVENTS.names
    # At most MOST_HOT_KEYS rows, see frequent_keys.
    apart = F.broadcast(keys)
    _write(tables.chartevents.join(apart, KEY, "left_anti"), root, "readings", names, buckets)
    tables.chartevents.join(apart, KEY, "left_semi").select(names).write.parquet(f"{root}/hot")
    _write(stays(tables), root, "stays", STAY_COLUMNS, buckets)
    tables.d_items.write.parquet(f"{root}/d_items")
    # Written last: a folder without it was not finished.
    spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.parquet(f"{root}/layout")
    return open_bucketed(spark, root)


def open_bucketed(spark: SparkSession, root: str) -> BucketedTables:
    """The tables that `land_bucketed` wrote."""
    buckets = spark.read.parquet(f"{root}/layout").first()["buckets"]
    return BucketedTables(
        _open(spark, root, "readings", CHARTEVENTS.names, buckets),
        spark.read.schema(CHARTEVENTS).parquet(f"{root}/hot"),
        spark.read.schema(f"{KEY} long").parquet(f"{root}/hot-keys"),
        _open(spark, root, "stays", STAY_COLUMNS, buckets),
        spark.read.parquet(f"{root}/d_items"),
        buckets,
        root,
    )


def drop_bucketed(tables: BucketedTables) -> None:
    """Delete what was landed."""
    remove(tables.stays.sparkSession, tables.root)


def observations(readings: DataFrame, d_items: DataFrame, text: Mapping[str, str] = ITEM_CODE_TEXT) -> DataFrame:
    """Complete observations of the readings; of bucketed ones without an exchange."""
    valid = valid_readings(readings, all_codes(code_lists(text)))
    tagged = valid.join(F.broadcast(known_codes(d_items, text)), "itemid")
    return complete_vitals(pivot_vitals(tagged, weight=F.col("times")))


def bucketed_features(tables: BucketedTables, text: Mapping[str, str] = ITEM_CODE_TEXT, repeated: str = "all") -> DataFrame:
    """The rows of `vitals.feature_table`, from bucketed tables.

    Bucketed readings, and the stays they are joined with, are not exchanged. Admissions kept apart send one row of sums
    per task and observation.
    """
    people = demographics(tables.stays, repeated)
    cold = observations(tables.readings, tables.d_items, text).join(people, KEY)
    keys = F.broadcast(tables.hot_keys)
    # Their demographics are as few as the keys, times the rows of a key.
    hot = observations(tables.hot, tables.d_items, text).join(people.join(keys, KEY, "left_semi"), KEY)
    return cold.union(hot.select(cold.columns))
