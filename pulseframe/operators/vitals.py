"""Long readings -> one row per observation with demographics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions import age_in_years, classify_item, mean_where
from pulseframe.operators.codes import all_codes, code_lists, known_codes
from pulseframe.operators.extract import stays, stays_are_small, valid_readings
from pulseframe.operators.joins import BROADCAST_BYTES, join_by_key
from pulseframe.schemas import (
    ITEM_CODE_TEXT,
    OBSERVATION_KEY,
    OTHER,
    REQUIRED_VITALS,
    VITAL_COLUMNS,
    ClinicalTables,
)


def with_measurement(readings: DataFrame, groups: Mapping[str, Sequence[int]]) -> DataFrame:
    return readings.withColumn("measurement", classify_item(F.col("itemid"), groups))


def classify(readings: DataFrame, groups: Mapping[str, Sequence[int]]) -> DataFrame:
    """Adds `measurement` and keeps only readings of a listed vital sign.

    Not being Other means having a listed code; tested on the code itself, the
    condition reaches the scan.
    """
    listed = readings.where(F.col("itemid").isin(all_codes(groups)))
    return with_measurement(listed, groups)


def classify_by_dimension(readings: DataFrame, codes: DataFrame) -> DataFrame:
    """As `with_measurement`, from a code table; its size is that of the code lists."""
    return readings.join(F.broadcast(codes), "itemid", "left").withColumn(
        "measurement", F.coalesce("measurement", F.lit(OTHER))
    )


def vital_means(weight: Column | None = None) -> list[Column]:
    """Mean per vital sign; `weight` says how often a reading counts."""
    value = F.col("valuenum")
    means = []
    for name, column in VITAL_COLUMNS.items():
        mine = F.col("measurement") == name
        if weight is None:
            means.append(mean_where(mine, value).alias(column))
        else:
            counted = F.sum(F.when(mine & value.isNotNull(), weight))
            means.append((F.sum(F.when(mine, value * weight)) / counted).alias(column))
    return means


def pivot_vitals(
    classified: DataFrame,
    key: Sequence[str] = tuple(OBSERVATION_KEY),
    weight: Column | None = None,
) -> DataFrame:
    """Mean per vital sign and observation; a vital that was not taken is NULL.

    Conditional means need one exchange; pivot() plans two. Partial sums are
    combined before it, so a huge admission or instant sends one row per task.
    """
    return classified.groupBy(*key).agg(*vital_means(weight))


def demographics(stay_rows: DataFrame, repeated: str = "all") -> DataFrame:
    """Distinct (hadm_id, gender, age) inputs: gender and birth date per admission.

    Accepts the extract or admissions joined with patients. `repeated` says what becomes of an
    admission with different demographic rows: "all" keeps them, and doubles its observations when
    joined; "first" keeps the least by gender, birth and admission, NULLs first; "error" raises a ValueError that
    names some of them, which takes a job.
    """
    if repeated not in ("all", "first", "error"):
        raise ValueError(f"repeated is {repeated!r}, not 'all', 'first' or 'error'")
    rows = stay_rows.select("hadm_id", "gender", "dob", "admittime")
    if repeated == "first":
        least = F.min(F.struct("gender", "dob", "admittime")).alias("least")
        rows = rows.groupBy("hadm_id").agg(least).select("hadm_id", "least.*")
    else:
        rows = rows.distinct()
    if repeated == "error":
        twice = rows.groupBy("hadm_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").take(5)
        if twice:
            raise ValueError(f"admissions with several demographic rows, among them {[row['hadm_id'] for row in twice]}")
    return (
        rows.select("hadm_id", "gender", age_in_years(F.col("dob"), F.col("admittime")).alias("age"))
    )


def complete_vitals(wide: DataFrame) -> DataFrame:
    """Observations with both pressures and a heart rate; MAP and age may be NULL."""
    return wide.dropna(subset=REQUIRED_VITALS)


def join_demographics(
    wide: DataFrame,
    tables: ClinicalTables,
    broadcast_bytes: int = BROADCAST_BYTES,
    repeated: str = "all",
) -> DataFrame:
    """Adds gender and age from the admissions and patients; `repeated` as in demographics.

    Where these are too large to broadcast, the observations are written first: hot admissions are
    then found among the rows that are joined, which may differ from those of the raw readings.
    """
    return join_by_key(
        wide,
        demographics(stays(tables, broadcast_bytes), repeated),
        "hadm_id",
        spread_by=["charttime"],
        small=stays_are_small(tables, broadcast_bytes),
        stage_facts=True,
        broadcast_bytes=broadcast_bytes,
    )


def preprocess_extract(
    extract: DataFrame,
    groups: Mapping[str, Sequence[int]],
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Extract -> complete observations with gender and age.

    The extract feeds two branches; stage it first if it is costly to compute. Demographics are the
    distinct ones of all its readings, which suits an extract with a limit; see feature_table.
    """
    classified = classify(extract, groups)
    return join_by_key(
        complete_vitals(pivot_vitals(classified)),
        demographics(classified),
        "hadm_id",
        spread_by=["charttime"],
        stage_facts=True,
        broadcast_bytes=broadcast_bytes,
    )


def feature_table(
    tables: ClinicalTables,
    text: Mapping[str, str] = ITEM_CODE_TEXT,
    broadcast_bytes: int = BROADCAST_BYTES,
    repeated: str = "all",
) -> DataFrame:
    """Four tables -> complete observations with gender and age.

    Same rows as preprocess_extract over the joined extract, ordered for scale:
    readings are narrowed at the scan, tagged by a broadcast of the codes known
    to the item dictionary (no more rows than the code lists have), averaged
    with map-side partial sums, and only complete observations meet the
    demographics, which come from the two small tables. A code that the dictionary lists n times makes
    its readings count n times, as a join with the dictionary does.
    """
    valid = valid_readings(tables.chartevents, all_codes(code_lists(text)))
    readings = valid.join(F.broadcast(known_codes(tables.d_items, text)), "itemid")
    wide = pivot_vitals(readings, weight=F.col("times"))
    return join_demographics(complete_vitals(wide), tables, broadcast_bytes, repeated)
