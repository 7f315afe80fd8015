"""Sensor messages -> typed readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.functions import is_missing, parse_sensor_payload
from pulseframe.schemas import SENSOR_FEATURES, SENSOR_MESSAGE


def parse_messages(
    messages: DataFrame, keep: Sequence[str] = (), value: str = "value"
) -> DataFrame:
    """`keep` columns and the five sensor fields; static or streaming.

    A message that is not JSON, or a field of the wrong type, gives NULLs and
    not an error: split_complete separates such rows before scoring.

    The struct is unpacked by a generator of one row, so each message is parsed
    once; a plain `data.*` would parse it again for every field that a later
    filter or expression names.
    """
    return messages.select(*keep, F.inline(F.array(parse_sensor_payload(F.col(value)))))


NOT_JSON, WRONG_TYPE, WRONG_CASE, MISSING = "not json", "wrong type", "wrong case", "missing"


def explain_messages(
    messages: DataFrame, required: Sequence[str] = tuple(SENSOR_FEATURES), keep: Sequence[str] = (), value: str = "value"
) -> DataFrame:
    """As parse_messages, with `raw`, the message as it came, and `reasons`: what is wrong with which required field.

    "not json": the message is no JSON object, named once, for the field `*`. "wrong type": the field is there with a value that
    is no number. "wrong case": only a key that differs in letter case is there. "missing": no such key, or a JSON
    null. A usable message has no reasons. Static or streaming; no function of Python's.
    """
    text = F.col(value).cast("string")
    given = F.from_json(text, "map<string,string>")
    # Text that breaks off is read up to there; only the corrupt record column tells.
    checked = F.from_json(text, f"{required[0]} string, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    read = messages.select(
        *keep,
        F.col(value).alias("raw"),
        F.inline(F.array(F.struct(parse_sensor_payload(F.col(value)).alias("parsed"), given.alias("given"), checked["_bad"].isNotNull().alias("bad")))),
    )

    def reason(field: str) -> Column:
        other = F.exists(F.map_keys("given"), lambda k: F.lower(k) == field.lower())
        return (
            F.when(~is_missing(F.col(f"parsed.{field}")), F.lit(None))
            .when(F.col("given")[field].isNotNull(), F.lit(WRONG_TYPE))
            .when(~F.map_contains_key("given", field) & other, F.lit(WRONG_CASE))
            .otherwise(F.lit(MISSING))
        )

    each = [F.when(reason(f).isNotNull(), F.struct(F.lit(f).alias("field"), reason(f).alias("reason"))) for f in required]
    whole = F.array(F.struct(F.lit("*").alias("field"), F.lit(NOT_JSON).alias("reason")))
    broken = F.col("given").isNull() | F.col("bad")
    return read.select(*keep, "parsed.*", F.when(broken, whole).otherwise(F.array_compact(F.array(*each))).alias("reasons"), "raw")


def split_by_reasons(explained: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable readings, the other messages as they came with their reasons)."""
    usable = F.size("reasons") == 0
    fields = [field.name for field in SENSOR_MESSAGE.fields]
    return explained.where(usable).drop("reasons", "raw"), explained.where(~usable).drop(*fields)
