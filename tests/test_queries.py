"""Every named query, against its SQL where there is one."""

from __future__ import annotations

import pytest
from compare import difference

import __spark_entry__ as entry

from pulseframe.plans.catalog import QUERIES
from pulseframe.plans.oracle import ORACLE_SQL as SQL


def test_all_are_registered():
    assert QUERIES.items() <= entry.queries().items()
    assert SQL.items() <= entry.oracle_sql().items()


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {
        "rf_metrics",
        "rf_predictions",
        "rf_feature_importance",
        "dual_target_predictions",
        "dual_target_metrics",
        "stream_scored",
        "stream_scored_inline",
    }


def test_entry(spark, small):
    flagship = entry.entry(spark)
    assert flagship.columns[:2] == ["hadm_id", "charttime"]
    assert flagship.count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, small, name):
    assert difference(QUERIES[name](spark, small), SQL[name], small) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0
