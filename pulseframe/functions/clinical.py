"""Column expressions. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulseframe.schemas import DAYS_PER_YEAR, OTHER, SENSOR_MESSAGE


def classify_item(itemid: Column, groups: Mapping[str, Sequence[int]]) -> Column:
    """Vital sign of an item code; the first matching group wins, NULL is Other."""
    verdict = F.when(itemid.isNull(), F.lit(OTHER))
    for measurement, codes in groups.items():
        verdict = verdict.when(itemid.isin(list(codes)), F.lit(measurement))
    return verdict.otherwise(F.lit(OTHER))


def age_in_years(dob: Column, at: Column) -> Column:
    """Whole days between the two calendar dates, as fractional years (double)."""
    return F.datediff(F.to_date(at), F.to_date(dob)) / F.lit(DAYS_PER_YEAR)


def mean_where(condition: Column, value: Column) -> Column:
    """Mean of `value` over the rows meeting `condition`; NULL if there are none."""
    return F.avg(F.when(condition, value))


def is_missing(column: Column) -> Column:
    """NULL or NaN: what MLlib refuses as a feature."""
    return column.isNull() | F.isnan(column)


def parse_sensor_payload(payload: Column) -> Column:
    """JSON text or bytes -> sensor struct. Bad input gives NULL fields."""
    return F.from_json(payload.cast("string"), SENSOR_MESSAGE)
