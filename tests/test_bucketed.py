"""Bucketed landing: same rows, no exchange of readings, hot admissions apart; one demographic row on request."""

from __future__ import annotations

from datetime import datetime as at

import pytest
from clinical import EXPECTED, golden_tables, rows

from pulseframe.operators import vitals
from pulseframe.plans.analogs import skewed_order_history
from pulseframe.sources import bucketed
from pulseframe.staging import exists


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def landed(spark):
    return bucketed.land_bucketed(golden_tables(spark), buckets=3, bucket_bytes=1 << 40)


def test_golden_rows(landed):
    assert rows(bucketed.bucketed_features(landed), "hadm_id", "charttime") == EXPECTED


def test_readings_are_not_exchanged(spark, landed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        people = vitals.demographics(landed.stays)
        plan = plan_of(bucketed.observations(landed.readings, landed.d_items).join(people, "hadm_id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(hadm_id" not in plan and "SortMergeJoin [hadm_id" in plan
    assert plan.count("Bucketed: true") == 2
    # Neither do the aggregations meet after a shuffle of the key's rows.
    above = [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]
    assert not [line for line in above if "charttime" in line]


def test_hot_admissions_lie_apart_and_open_again(spark, small):
    tables = skewed_order_history(spark, small)
    landed = bucketed.land_bucketed(tables, buckets=4)
    assert [r[0] for r in landed.hot_keys.collect()] == [5]
    assert landed.hot.count() == tables.chartevents.where("hadm_id = 5").count()
    assert landed.readings.where("hadm_id = 5").isEmpty()
    again = bucketed.open_bucketed(spark, landed.root)
    assert again.buckets == 4
    expected = vitals.feature_table(tables)
    found = bucketed.bucketed_features(again)
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
    bucketed.drop_bucketed(again)
    assert not exists(spark, landed.root)


def test_empty_tables(spark):
    tables = golden_tables(spark)
    from dataclasses import replace

    landed = bucketed.land_bucketed(replace(tables, chartevents=tables.chartevents.limit(0)), buckets=2)
    assert bucketed.bucketed_features(landed).count() == 0


def test_repeated_demographics(spark):
    tables = golden_tables(spark, patients=[(1, "M", at(1949, 1, 1), None), (2, "F", at(1980, 6, 15), None)])
    assert vitals.feature_table(tables).count() == len(EXPECTED) + 2
    first = vitals.feature_table(tables, repeated="first")
    assert [r.age for r in first.where("hadm_id = 100").collect()] == [pytest.approx(19052 / 365.25)]
    assert first.count() == len(EXPECTED)
    with pytest.raises(ValueError, match="100"):
        vitals.feature_table(tables, repeated="error")
    with pytest.raises(ValueError, match="often"):
        vitals.feature_table(tables, repeated="often")
    assert vitals.feature_table(golden_tables(spark), repeated="error").count() == len(EXPECTED)
