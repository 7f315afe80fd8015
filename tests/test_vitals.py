from __future__ import annotations

from datetime import datetime as at

import pytest
from clinical import CHART_ROWS, EXPECTED, golden_tables, rows
from pyspark.sql import functions as F

from pulseframe.functions import age_in_years
from pulseframe.operators import quality, vitals
from pulseframe.operators.codes import all_codes, code_dimension, code_lists
from pulseframe.operators.extract import EXTRACT_COLUMNS, clinical_extract, join_clinical_tables
from pulseframe.schemas import CHARTEVENTS, VITAL_COLUMNS

GROUPS = code_lists()
CODES = all_codes(GROUPS)


@pytest.fixture(scope="module")
def tables(spark):
    return golden_tables(spark)


@pytest.fixture(scope="module")
def extracted(tables):
    return clinical_extract(tables, CODES)


def test_fixture_size():
    assert len(CHART_ROWS) == 22


def test_extract(extracted):
    assert extracted.columns == EXTRACT_COLUMNS
    assert extracted.count() == 18


def test_join_keeps_flagged_and_unlisted_but_not_unknown_codes(tables):
    joined = join_clinical_tables(tables)
    assert joined.count() == 21
    assert joined.where("itemid = 442").isEmpty()


def test_classified_counts(extracted):
    counted = vitals.classify(extracted, GROUPS).groupBy("measurement").count()
    assert dict(rows(counted)) == {
        "Systolic BP": 7,
        "Diastolic BP": 5,
        "MAP": 2,
        "Heart Rate": 4,
    }


def test_step_counts(extracted):
    counts = quality.step_counts(vitals.classify(extracted, GROUPS))
    assert rows(counts) == [(18, 6, 4)]


@pytest.mark.parametrize("broadcast_bytes", [0, 32 << 20])
def test_golden_features(tables, extracted, broadcast_bytes):
    direct = vitals.feature_table(tables, broadcast_bytes=broadcast_bytes)
    through_extract = vitals.preprocess_extract(extracted, GROUPS, broadcast_bytes)
    for features in (direct, through_extract):
        assert rows(features.select(*direct.columns), "hadm_id", "charttime") == EXPECTED


def test_limit_is_a_total_order(tables):
    whole = rows(clinical_extract(tables, CODES), *["hadm_id", "charttime", "itemid"])
    for limit in (1, 3, 7, 18, 50):
        first = clinical_extract(tables, CODES, limit=limit)
        assert rows(first, "hadm_id", "charttime", "itemid") == whole[:limit]


def test_null_and_unlisted_codes_are_other(spark):
    codes = spark.createDataFrame([(None,), (1,), (51,), (211,)], "itemid int")
    by_case = vitals.with_measurement(codes, GROUPS)
    by_table = vitals.classify_by_dimension(codes, code_dimension(spark))
    expected = [(None, "Other"), (1, "Other"), (51, "Systolic BP"), (211, "Heart Rate")]
    assert rows(by_case, "itemid") == expected
    assert rows(by_table.select("itemid", "measurement"), "itemid") == expected
    assert vitals.classify(codes, GROUPS).count() == 2


def test_first_group_wins(spark):
    text = {"MAP": " 7, 8", "Heart Rate": "8 ,9"}
    groups = code_lists(text)
    assert groups == {"MAP": [7, 8], "Heart Rate": [8, 9]}
    assert rows(code_dimension(spark, text)) == [(7, "MAP"), (8, "MAP"), (9, "Heart Rate")]
    tagged = vitals.with_measurement(spark.createDataFrame([(8,)], "itemid int"), groups)
    assert rows(tagged) == [(8, "MAP")]


def test_pivot_equals_builtin_pivot(spark, small):
    from pulseframe.plans.analogs import event_log

    readings = vitals.classify(event_log(spark, small).chartevents, GROUPS)
    ours = vitals.pivot_vitals(readings)
    builtin = (
        readings.groupBy("hadm_id", "charttime")
        .pivot("measurement", list(VITAL_COLUMNS))
        .agg(F.mean("valuenum"))
        .toDF(*ours.columns)
    )

    def close(df):
        cells = [F.round(c, 9).alias(c) for c in VITAL_COLUMNS.values()]
        return rows(df.select("hadm_id", "charttime", *cells), "hadm_id", "charttime")

    assert close(ours) == close(builtin)


def test_two_demographic_rows_double_the_observations(spark):
    tables = golden_tables(spark, patients=[(1, "F", at(1950, 2, 28), None)])
    features = vitals.feature_table(tables)
    through_extract = vitals.preprocess_extract(clinical_extract(tables, CODES), GROUPS)
    assert features.count() == through_extract.count() == 6
    repeated = quality.repeated_keys(tables.patients, "subject_id")
    assert rows(repeated) == [(1, 2)]


def test_exact_duplicates_do_not_fan_out(spark):
    tables = golden_tables(spark, patients=[(1, "M", at(1950, 2, 28), None)])
    assert rows(vitals.feature_table(tables), "hadm_id", "charttime") == EXPECTED


def test_nan_counts_as_missing(spark):
    wide = spark.createDataFrame(
        [(1.0, 2.0, 3.0), (float("nan"), 2.0, 3.0), (1.0, None, 3.0)],
        "systolic_bp double, diastolic_bp double, heart_rate double",
    )
    assert vitals.complete_vitals(wide).count() == 1


def test_age(spark):
    dates = spark.createDataFrame(
        [(at(1950, 2, 28), at(2001, 3, 1, 23, 59, 59)), (None, at(2001, 1, 1))],
        "dob timestamp, admitted timestamp",
    )
    ages = dates.select(age_in_years(F.col("dob"), F.col("admitted")).alias("age"))
    assert [r.age for r in ages.collect()] == [18629 / 365.25, None]


def test_empty_readings(spark, tables):
    from dataclasses import replace

    empty = replace(tables, chartevents=spark.createDataFrame([], CHARTEVENTS))
    assert vitals.feature_table(empty).count() == 0
    assert vitals.feature_table(empty, broadcast_bytes=0).count() == 0


def test_validation(spark):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    assert quality.validate(df, ["n"]) == 1
    with pytest.raises(ValueError, match="None"):
        quality.validate(None, ["n"])
    with pytest.raises(ValueError, match="lacks columns"):
        quality.validate(df, ["n", "x"])
    with pytest.raises(ValueError, match="no rows"):
        quality.validate(df.where("n > 1"), ["n"])
    assert rows(quality.summary(df, "small")) == [("small", 1, 2, "n, s")]


def test_key_at_finds_the_running_count(spark):
    from pulseframe.operators import extract

    counts = spark.createDataFrame([(k * k * 1000, 3) for k in range(-30, 200)], "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))
    ordered = sorted((r.k, r.n) for r in counts.collect())
    for rank in (1, 3, 4, 100, 500, sum(n for _, n in ordered)):
        below = 0
        for key, n in ordered:
            if below + n >= rank:
                break
            below += n
        assert extract.key_at(counts, "k", rank) == (key, below)
    assert extract.key_at(counts, "k", 10_000) == (None, sum(n for _, n in ordered))
    assert extract.key_at(counts.limit(0), "k", 1) == (None, 0)


def test_top_n_sorts_only_the_rest(spark, small):
    from pulseframe.operators import extract
    from pulseframe.operators.codes import all_codes, code_lists
    from pulseframe.plans.analogs import skewed_order_history

    tables = skewed_order_history(spark, small)
    whole = extract.clinical_extract(tables, all_codes(code_lists()))
    assert extract.first_in_chart_order(whole, 0).count() == 0
    ordered = [tuple(r) for r in extract.in_chart_order(whole).collect()]
    for limit in (7, 700, len(ordered) + 5):
        first = extract.first_in_chart_order(whole, limit)
        assert [tuple(r) for r in first.collect()] == ordered[:limit]
    plan = extract.first_in_chart_order(whole, 7)._jdf.queryExecution().optimizedPlan().toString()
    assert "hadm_id" in plan and "<" in plan
