"""Tables from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulseframe.schemas import CLINICAL_SCHEMAS, ClinicalTables

# What a file stream reads at a time by default; how much trains a model is a setting of its own.
BATCH_BYTES = 64 << 30


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


def stream_table(
    spark: SparkSession, base: str, name: str, max_bytes_per_trigger: int = BATCH_BYTES
) -> DataFrame:
    """The same table as a file stream, in micro-batches of bounded size.

    A file stream refuses the path of a single file but takes a glob, which
    also matches a table kept as a directory of part files.
    """
    schema = read_table(spark, base, name).schema
    reader = spark.readStream.schema(schema).option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.parquet(f"{base}/{name}.parque[t]")


def read_clinical_tables(spark: SparkSession, base: str) -> ClinicalTables:
    """The four clinical tables from Parquet folders, with declared schemas."""

    return ClinicalTables(
        **{
            name: spark.read.schema(schema).parquet(f"{base}/{name}")
            for name, schema in CLINICAL_SCHEMAS.items()
        }
    )
