"""Validation, summaries and the split of usable from unusable rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pulseframe.functions import is_missing
from pulseframe.operators.vitals import vital_means
from pulseframe.schemas import OBSERVATION_KEY, REQUIRED_VITALS


def require_columns(df: DataFrame | None, required: Sequence[str], name: str = "DataFrame") -> None:
    """Schema check only; runs no job."""
    if df is None:
        raise ValueError(f"{name} is None: was the source read?")
    missing = [column for column in required if column not in df.columns]
    if missing:
        raise ValueError(f"{name} lacks columns {missing}; it has {df.columns}")


def validate(df: DataFrame | None, required: Sequence[str], name: str = "DataFrame") -> int:
    """Row count of a frame that has the columns and at least one row, else ValueError."""
    require_columns(df, required, name)
    rows = df.count()
    if rows == 0:
        raise ValueError(f"{name} has no rows")
    return rows


def summary(df: DataFrame, name: str = "DataFrame") -> DataFrame:
    """One row: name, n_rows, n_cols, columns. Counting reads no column data."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("name"),
        "n_rows",
        F.lit(len(df.columns)).cast("bigint").alias("n_cols"),
        F.lit(", ".join(df.columns)).alias("columns"),
    )


def step_counts(classified: DataFrame, key: Sequence[str] = tuple(OBSERVATION_KEY)) -> DataFrame:
    """Rows after classification, pivot and null drop, in one pass over the readings."""
    wide = classified.groupBy(*key).agg(*vital_means(), F.count(F.lit(1)).alias("n_readings"))
    return wide.agg(
        F.sum("n_readings").alias("n_readings"),
        F.count(F.lit(1)).alias("n_observations"),
        F.count_if(has_all(REQUIRED_VITALS)).alias("n_complete"),
    )


def observed_steps(
    classified: DataFrame, key: Sequence[str] = tuple(OBSERVATION_KEY)
) -> tuple[DataFrame, dict[str, Observation]]:
    """Complete observations, and counts of the steps before them that are taken while these rows are computed.

    The counts are those of step_counts, without a job of their own: any action on the frame fills them, and
    `steps_seen` waits for it. An action that reads a part of the rows counts a part, and a stage that is run again
    after a loss may count its rows twice.
    """
    seen = {"readings": Observation("readings"), "observations": Observation("observations")}
    readings = classified.observe(seen["readings"], F.count(F.lit(1)).alias("n_readings"))
    wide = readings.groupBy(*key).agg(*vital_means())
    counts = [F.count(F.lit(1)).alias("n_observations"), F.count_if(has_all(REQUIRED_VITALS)).alias("n_complete")]
    return wide.observe(seen["observations"], *counts).dropna(subset=REQUIRED_VITALS), seen


def steps_seen(seen: dict[str, Observation]) -> dict[str, int]:
    """The counts of an action that has run, or runs."""
    return {name: count for step in seen.values() for name, count in step.get.items()}


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """(key, n_rows) of keys that should be unique and are not."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def has_all(required: Sequence[str]) -> Column:
    """Whether none of the required numeric fields is NULL or NaN."""
    return reduce(lambda a, b: a & b, [~is_missing(F.col(c)) for c in required])


def missing_fields(required: Sequence[str]) -> Column:
    """Array: which required fields are NULL or NaN."""
    named = [F.when(is_missing(F.col(c)), F.lit(c)) for c in required]
    return F.array_compact(F.array(*named))


def split_complete(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(usable rows, the other rows with `missing`: the fields they lack).

    Works on streams too. Together the two hold every input row once.
    """
    usable = has_all(required)
    return df.where(usable), df.where(~usable).withColumn("missing", missing_fields(required))
