from pulseframe.functions.buckets import portable_bucket
from pulseframe.functions.clinical import (
    age_in_years,
    classify_item,
    is_missing,
    mean_where,
    parse_sensor_payload,
)

__all__ = [
    "age_in_years",
    "classify_item",
    "is_missing",
    "mean_where",
    "parse_sensor_payload",
    "portable_bucket",
]
