"""The physical plans the operators are written for."""

from __future__ import annotations

import re

import pytest
from clinical import golden_tables

from pulseframe.operators.codes import all_codes, code_lists
from pulseframe.operators.extract import clinical_extract
from pulseframe.operators.vitals import classify, feature_table, pivot_vitals
from pulseframe.plans.catalog import QUERIES
from pulseframe.sources.tables import read_clinical_tables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("clinic"))
    golden = golden_tables(spark)
    for name in ("patients", "admissions", "chartevents", "d_items"):
        getattr(golden, name).write.parquet(f"{base}/{name}")
    return read_clinical_tables(spark, base)


def test_filters_and_columns_reach_the_scan(tables):
    plan = plan_of(feature_table(tables))
    chart = next(line for line in plan.splitlines() if "chartevents" in line)
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", chart)[1]
    assert "IsNull(error)" in pushed and "IsNotNull(valuenum)" in pushed
    assert "In(itemid" in pushed
    schema = re.search(r"ReadSchema: (.*)", chart)[1]
    for column in ("hadm_id", "itemid", "charttime", "valuenum", "error"):
        assert column in schema
    assert "value:string" not in schema and "valueuom" not in schema


def test_case_classification_also_reaches_the_scan(tables):
    plan = plan_of(classify(tables.chartevents, code_lists()))
    assert "In(itemid" in plan


def test_one_exchange_for_the_pivot(tables):
    plan = plan_of(pivot_vitals(classify(tables.chartevents, code_lists())))
    assert len(re.findall(r"(?<!Broadcast)Exchange hashpartitioning", plan)) == 1


def test_readings_are_shuffled_once_in_the_feature_table(tables):
    plan = plan_of(feature_table(tables))
    wide = [line for line in plan.splitlines() if "hashpartitioning(hadm_id" in line]
    assert sum("charttime" in line for line in wide) == 1
    assert "SortMergeJoin" not in plan


def test_row_numbers_cost_nothing_without_salting(tables):
    extract = clinical_extract(tables, all_codes(code_lists()))
    plan = plan_of(extract.where("charttime > '2005-01-01'"))
    assert "monotonically_increasing_id" not in plan
    assert "GreaterThan(charttime" in plan


def test_top_n_is_not_a_global_sort(tables):
    plan = plan_of(clinical_extract(tables, all_codes(code_lists()), limit=5))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


@pytest.mark.parametrize(
    "name",
    ["chart_extract", "feature_table", "weekly_features", "step_counts", "json_parse",
     "demographics", "vitals_with_demographics", "hash_split_counts", "rejected_messages"],
)
def test_no_python_and_no_cross_join(spark, small, name):
    plan = plan_of(QUERIES[name](spark, small))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval", "SinglePartition"):
        if word == "SinglePartition" and name == "step_counts":
            continue
        assert word not in plan, word
