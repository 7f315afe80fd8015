"""The golden clinical fixture."""

from __future__ import annotations

from datetime import datetime as at

from pulseframe.operators.codes import all_codes, code_lists
from pulseframe.schemas import ADMISSIONS, CHARTEVENTS, D_ITEMS, PATIENTS, ClinicalTables

FIRST, SECOND = at(2001, 3, 2, 1), at(2001, 3, 2, 2)


def _row(hadm, time, item, number, value=None, error=None):
    return (hadm, item, time, value or str(number), number, "unit", error)


CHART_ROWS = [
    _row(100, FIRST, 51, 120.0),
    _row(100, FIRST, 455, 130.0),
    _row(100, FIRST, 8368, 80.0),
    _row(100, FIRST, 211, 70.0),
    _row(100, FIRST, 52, 95.0),
    _row(100, SECOND, 51, 118.0),
    _row(100, SECOND, 52, 90.0),
    _row(101, at(2005, 7, 1, 9), 220179, 140.0),
    _row(101, at(2005, 7, 1, 9), 220180, 85.0),
    _row(101, at(2005, 7, 1, 9), 220045, 88.0),
    _row(101, at(2005, 7, 1, 9), 220045, 300.0, error="1"),
    _row(200, at(2010, 6, 14, 13), 6, 110.0),
    _row(200, at(2010, 6, 14, 13), 8364, 70.0),
    _row(200, at(2010, 6, 14, 13), 211, None, value="n/a"),
    _row(200, at(2010, 6, 14, 14), 6701, 112.0),
    _row(200, at(2010, 6, 14, 14), 8555, 72.0),
    _row(200, at(2010, 6, 14, 14), 211, 64.0),
    _row(200, at(2010, 6, 14, 14), 999, 37.0),
    _row(300, at(2012, 1, 1, 1), 51, 125.0),
    _row(300, at(2012, 1, 1, 1), 8368, 82.0),
    _row(300, at(2012, 1, 1, 1), 211, 77.0),
    _row(300, at(2012, 1, 1, 1), 442, 1.0),
]

EXPECTED = [
    (100, FIRST, 125.0, 80.0, 95.0, 70.0, "M", 51.00342231348392),
    (101, at(2005, 7, 1, 9), 140.0, 85.0, None, 88.0, "M", 55.337440109514034),
    (200, at(2010, 6, 14, 14), 112.0, 72.0, None, 64.0, "F", 29.9958932238193),
    (300, at(2012, 1, 1, 1), 125.0, 82.0, None, 77.0, "F", None),
]


def golden_tables(spark, patients=()):
    people = [
        (1, "M", at(1950, 2, 28), None),
        (2, "F", at(1980, 6, 15), None),
        (3, "F", None, None),
        *patients,
    ]
    stays = [
        (1, 100, at(2001, 3, 1, 23, 59, 59), None),
        (1, 101, at(2005, 7, 1, 8), None),
        (2, 200, at(2010, 6, 14, 12), None),
        (3, 300, at(2012, 1, 1), None),
    ]
    items = [(code, f"item {code}", "unit") for code in all_codes(code_lists())]
    items.append((999, "Temp", "unit"))
    return ClinicalTables(
        spark.createDataFrame(people, PATIENTS),
        spark.createDataFrame(stays, ADMISSIONS),
        spark.createDataFrame(CHART_ROWS, CHARTEVENTS),
        spark.createDataFrame(items, D_ITEMS),
    )


def rows(df, *order):
    return [tuple(row) for row in df.orderBy(*(order or df.columns)).collect()]
