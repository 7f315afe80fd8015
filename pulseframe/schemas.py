"""Table schemas and the fixed values the engine shares."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _schema(*fields):
    return StructType([StructField(name, kind(), True) for name, kind in fields])


PATIENTS = _schema(
    ("subject_id", LongType),
    ("gender", StringType),
    ("dob", TimestampType),
    ("dod", TimestampType),
)

ADMISSIONS = _schema(
    ("subject_id", LongType),
    ("hadm_id", LongType),
    ("admittime", TimestampType),
    ("dischtime", TimestampType),
)

CHARTEVENTS = _schema(
    ("hadm_id", LongType),
    ("itemid", IntegerType),
    ("charttime", TimestampType),
    ("value", StringType),
    ("valuenum", DoubleType),
    ("valueuom", StringType),
    ("error", StringType),
)

D_ITEMS = _schema(
    ("itemid", IntegerType),
    ("label", StringType),
    ("unitname", StringType),
)

CLINICAL_SCHEMAS = {
    "patients": PATIENTS,
    "admissions": ADMISSIONS,
    "chartevents": CHARTEVENTS,
    "d_items": D_ITEMS,
}

# The JSON keys of one sensor message, in wire order.
SENSOR_MESSAGE = _schema(
    ("PTT", FloatType),
    ("PIR", FloatType),
    ("HR", FloatType),
    ("SBP", FloatType),
    ("DBP", FloatType),
)
SENSOR_FEATURES = ["PTT", "PIR", "HR"]
SENSOR_TARGETS = ["SBP", "DBP"]

# Which item codes make up which vital sign.
ITEM_CODE_TEXT = {
    "Systolic BP": "6,51,455,6701,220050,220179",
    "Diastolic BP": "8364,8368,8440,8441,8555,220051,220180",
    "MAP": "52,456,6702,220052,220181",
    "Heart Rate": "211,220045",
}
OTHER = "Other"

# Names of the wide table's columns, vital sign -> column of the wide table.
VITAL_COLUMNS = {
    "Systolic BP": "systolic_bp",
    "Diastolic BP": "diastolic_bp",
    "MAP": "map",
    "Heart Rate": "heart_rate",
}
REQUIRED_VITALS = ["systolic_bp", "diastolic_bp", "heart_rate"]

# Key, label and features of the batch model.
OBSERVATION_KEY = ["hadm_id", "charttime"]
BATCH_LABEL = "systolic_bp"
BATCH_FEATURES = ["diastolic_bp", "heart_rate", "gender_index", "age"]

DAYS_PER_YEAR = 365.25


@dataclass(frozen=True)
class ClinicalTables:
    """The four relational inputs."""

    patients: DataFrame
    admissions: DataFrame
    chartevents: DataFrame
    d_items: DataFrame
