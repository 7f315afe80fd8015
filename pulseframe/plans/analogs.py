"""The clinical tables, derived from general test tables.

Two views of them: order history (customer, orders, lineitem, part) in the role
of patients, admissions, readings and dictionary; and an event log, with users
as admissions and event types as vital signs. Flags, NULLs and unknown codes
are derived from the rows, since the test tables have none.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.operators.codes import all_codes, code_lists
from pulseframe.schemas import ClinicalTables
from pulseframe.sources.tables import read_table

UNLISTED_CODE = 999  # in the dictionary, in no group
UNKNOWN_CODE = 442  # not even in the dictionary
HOT_ADMISSION = 5
REPEATED_CODE = 51
EVENT_CODES = {"click": 51, "view": 8368, "signup": 52, "purchase": 211, "error": UNLISTED_CODE}


def _pick(codes, index):
    return F.element_at(F.array(*[F.lit(c) for c in codes]), (index % len(codes) + 1).cast("int"))


def patients(spark: SparkSession, base: str) -> DataFrame:
    key = F.col("c_custkey")
    born = F.date_add(F.lit("1930-01-01").cast("date"), (key * 37 % 25000).cast("int"))
    return (
        read_table(spark, base, "customer")
        .withColumn("born", F.when(key % 40 != 7, born))
        .select(
            key.alias("subject_id"),
            F.col("c_mktsegment").alias("gender"),
            F.col("born").cast("timestamp").alias("dob"),
            F.when(key % 3 == 0, F.date_add("born", 29220)).cast("timestamp").alias("dod"),
        )
    )


def dictionary(spark: SparkSession, base: str) -> DataFrame:
    """One row per item code, labelled from the parts that map to it."""
    codes = [*all_codes(code_lists()), UNLISTED_CODE]
    return (
        read_table(spark, base, "part")
        .groupBy(_pick(codes, F.col("p_partkey")).alias("itemid"))
        .agg(F.min("p_name").alias("label"), F.min("p_type").alias("unitname"))
    )


def _line_readings(lines: DataFrame, every: str = "year", has_rate: Column | None = None) -> DataFrame:
    """Readings at the start of `every` period; heart rates where `has_rate` holds, by default all."""
    line, part = F.col("l_linenumber"), F.col("l_partkey")
    groups = code_lists()
    itemid = (
        F.when(line.isin(1, 2), _pick(groups["Systolic BP"], part))
        .when(line.isin(3, 4), _pick(groups["Diastolic BP"], part))
        .when(line == 5, _pick(groups["MAP"], part))
        .when((line == 6) & (F.lit(True) if has_rate is None else has_rate), _pick(groups["Heart Rate"], part))
        .otherwise(_pick([UNLISTED_CODE, UNKNOWN_CODE], part))
    )
    return lines.select(
        F.col("l_orderkey").alias("hadm_id"),
        itemid.alias("itemid"),
        F.date_trunc(every, "l_shipdate").alias("charttime"),
        F.col("l_quantity").cast("int").cast("string").alias("value"),
        F.when(F.col("l_suppkey") % 13 != 5, F.col("l_quantity")).alias("valuenum"),
        F.when(line == 6, "bpm").otherwise("mmHg").alias("valueuom"),
        F.when(F.col("l_discount") > 0.095, "1").alias("error"),
    )


def order_history(spark: SparkSession, base: str) -> ClinicalTables:
    """Line numbers 1-2 systolic, 3-4 diastolic, 5 MAP, 6 heart rate, 7 other; by year."""
    orders = read_table(spark, base, "orders")
    admissions = orders.select(
        F.col("o_custkey").alias("subject_id"),
        F.col("o_orderkey").alias("hadm_id"),
        F.col("o_orderdate").cast("timestamp").alias("admittime"),
        F.date_add("o_orderdate", (F.col("o_orderkey") % 20).cast("int"))
        .cast("timestamp")
        .alias("dischtime"),
    )
    chartevents = _line_readings(read_table(spark, base, "lineitem"))
    return ClinicalTables(
        patients(spark, base), admissions, chartevents, dictionary(spark, base)
    )


def skewed_order_history(spark: SparkSession, base: str) -> ClinicalTables:
    """Order history in which one admission holds a third of all readings."""
    tables = order_history(spark, base)
    lines = read_table(spark, base, "lineitem")
    moved = (F.col("l_partkey") + F.col("l_suppkey")) % 3 == 0
    key = F.when(moved, HOT_ADMISSION).otherwise(F.col("l_orderkey"))
    return replace(tables, chartevents=_line_readings(lines.withColumn("l_orderkey", key)))


def late_skewed_order_history(spark: SparkSession, base: str) -> ClinicalTables:
    """One admission has a twentieth of the readings but nearly all heart rates, so most complete observations."""
    tables = order_history(spark, base)
    moved = (F.col("l_partkey") + F.col("l_suppkey")) % 20 == 0
    key = F.when(moved, HOT_ADMISSION).otherwise(F.col("l_orderkey"))
    few = (F.col("l_orderkey") == HOT_ADMISSION) | (F.col("l_orderkey") % 16 == 0)
    lines = read_table(spark, base, "lineitem").withColumn("l_orderkey", key)
    return replace(tables, chartevents=_line_readings(lines, "month", few))


def repeated_dictionary(spark: SparkSession, base: str) -> ClinicalTables:
    """Order history in whose dictionary one listed code stands twice."""
    tables = order_history(spark, base)
    again = tables.d_items.where(F.col("itemid") == REPEATED_CODE)
    return replace(tables, d_items=tables.d_items.union(again))


def repeated_patients(spark: SparkSession, base: str) -> ClinicalTables:
    """Order history in which every fifth patient has a second row with another birth date."""
    tables = order_history(spark, base)
    again = tables.patients.where(F.col("subject_id") % 5 == 0)
    later = again.withColumn("dob", F.date_add("dob", 100).cast("timestamp"))
    return replace(tables, patients=tables.patients.union(later))


def event_log(spark: SparkSession, base: str, numbered: bool = False) -> ClinicalTables:
    """Events of a user in a week form one observation; `numbered` readings keep their event_id."""
    people = patients(spark, base)
    admitted = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("subject_id") % 7).cast("int"))
    admissions = people.select(
        "subject_id",
        F.col("subject_id").alias("hadm_id"),
        admitted.cast("timestamp").alias("admittime"),
        F.date_add(admitted, 30).cast("timestamp").alias("dischtime"),
    )
    itemid = F.when(F.lit(False), F.lit(0))
    for name, code in EVENT_CODES.items():
        itemid = itemid.when(F.col("event_type") == name, F.lit(code))
    chartevents = read_table(spark, base, "events").select(
        F.col("user_id").alias("hadm_id"),
        itemid.alias("itemid"),
        F.date_trunc("week", "ts").alias("charttime"),
        F.col("value").cast("string").alias("value"),
        F.col("value").alias("valuenum"),
        F.lit("unit").alias("valueuom"),
        F.when(F.col("event_id") % 29 == 3, "1").alias("error"),
        *(["event_id"] if numbered else []),
    )
    return ClinicalTables(people, admissions, chartevents, dictionary(spark, base))


def sensor_messages(events: DataFrame) -> DataFrame:
    """(event_id, value BINARY) sensor messages from events; error events are not JSON."""
    number = F.col("event_id")
    pulse = F.struct(
        F.col("value").alias("PTT"),
        (F.get_json_object("props", "$.k").cast("int") / 8.0).alias("PIR"),
        (F.col("user_id") % 64 + 50).alias("HR"),
        F.when(number % 10 != 0, number % 60 + 90).alias("SBP"),
        F.when(number % 10 != 0, number % 40 + 60).alias("DBP"),
    )
    text = F.when(F.col("event_type") == "error", F.lit("bad")).otherwise(F.to_json(pulse))
    return events.select("event_id", text.cast("binary").alias("value"))


def faulty_messages(events: DataFrame) -> DataFrame:
    """Sensor messages of which five in seven have a fault of a kind: no JSON, cut off, wrong type, wrong case, missing."""
    kind = F.col("event_id") % 7
    heart, time = (F.col("user_id") % 64 + 50).cast("string"), F.col("event_id").cast("string")
    rest = F.concat(F.lit('"PTT":'), time, F.lit(',"PIR":0.5'))
    text = (
        F.when(kind == 0, F.lit("no json"))
        .when(kind == 1, F.concat(F.lit("{"), rest))
        .when(kind == 2, F.concat(F.lit("{"), rest, F.lit(',"HR":"fast"}')))
        .when(kind == 3, F.concat(F.lit("{"), rest, F.lit(',"hr":'), heart, F.lit("}")))
        .when(kind == 4, F.lit('{"HR":null,"PIR":0.5}'))
        .otherwise(F.concat(F.lit("{"), rest, F.lit(',"HR":'), heart, F.lit("}")))
    )
    return events.select("event_id", text.cast("binary").alias("value"))
