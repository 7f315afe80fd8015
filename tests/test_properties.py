"""Random small inputs against plain Python."""

from __future__ import annotations

import math
from collections import defaultdict

from clinical import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulseframe.operators import joins, metrics, split, vitals
from pulseframe.operators.codes import code_lists
from pulseframe.operators.quality import split_complete
from pulseframe.schemas import VITAL_COLUMNS

FEW = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
KEYS = st.one_of(st.just(1), st.just(1), st.integers(0, 6), st.none())


@FEW
@given(st.lists(KEYS, max_size=60), st.lists(KEYS, max_size=8))
def test_join_forms(spark, left, right):
    facts = spark.createDataFrame([(k, n) for n, k in enumerate(left)], "k long, n int")
    dims = spark.createDataFrame([(k, m) for m, k in enumerate(right)], "k long, m int")
    expected = sorted(
        (a, n, m)
        for n, a in enumerate(left)
        for m, b in enumerate(right)
        if a is not None and a == b
    )
    for limit in (0, 1 << 62):
        joined = joins.join_by_key(facts, dims, "k", spread_by=["n"], broadcast_bytes=limit)
        assert sorted(tuple(r) for r in joined.collect()) == expected
    forced = joins._salted_join(facts, dims, "k", ["n"], {1: 0.5, 3: 0.01})
    assert sorted(tuple(r) for r in forced.collect()) == expected


READINGS = st.tuples(
    st.integers(1, 3),
    st.sampled_from([51, 455, 8368, 52, 211, 999]),
    st.one_of(st.none(), st.integers(-50, 200).map(float)),
)


@FEW
@given(st.lists(READINGS, max_size=40))
def test_pivot(spark, readings):
    groups = code_lists()
    df = spark.createDataFrame(readings, "hadm_id long, itemid int, valuenum double")
    cells = defaultdict(list)
    admissions = set()
    for admission, code, value in readings:
        for name, codes in groups.items():
            if code in codes:
                admissions.add(admission)
                if value is not None:
                    cells[admission, name].append(value)

    def mean(admission, name):
        values = cells[admission, name]
        return round(sum(values) / len(values), 9) if values else None

    expected = [(a, *[mean(a, name) for name in VITAL_COLUMNS]) for a in sorted(admissions)]
    wide = vitals.pivot_vitals(vitals.classify(df, groups), ["hadm_id"])
    shown = wide.select("hadm_id", *[F.round(c, 9).alias(c) for c in VITAL_COLUMNS.values()])
    assert rows(shown, "hadm_id") == expected


@FEW
@given(
    st.lists(
        st.tuples(st.integers(-99, 99).map(float), st.integers(-99, 99).map(float)),
        min_size=1,
        max_size=30,
    )
)
def test_metrics(spark, pairs):
    scored = spark.createDataFrame(pairs, "y double, prediction double")
    n = len(pairs)
    errors = [y - p for y, p in pairs]
    mean = sum(y for y, _ in pairs) / n
    total = sum((y - mean) ** 2 for y, _ in pairs)
    got = metrics.regression_metrics(scored, "y").first()
    assert got.n_rows == n
    assert math.isclose(got.mae, sum(map(abs, errors)) / n, abs_tol=1e-9)
    assert math.isclose(got.rmse, math.sqrt(sum(e * e for e in errors) / n), abs_tol=1e-9)
    if total > 1e-6:
        assert math.isclose(got.r2, 1 - sum(e * e for e in errors) / total, rel_tol=1e-9, abs_tol=1e-9)


@FEW
@given(
    st.lists(st.tuples(KEYS, st.one_of(st.none(), st.text(max_size=3))), max_size=50),
    st.floats(0, 1),
    st.integers(0, 5),
)
def test_split(spark, keys, ratio, seed):
    df = spark.createDataFrame([(*k, n) for n, k in enumerate(keys)], "a long, b string, n int")
    parts = split.key_split(df, ["a", "b"], ratio, seed)
    sides = [{r.n for r in part.collect()} for part in parts]
    assert not sides[0] & sides[1]
    assert sides[0] | sides[1] == set(range(len(keys)))
    by_key = defaultdict(set)
    for n, key in enumerate(keys):
        by_key[key].add(n in sides[0])
    assert all(len(side) == 1 for side in by_key.values())


NUMBERS = st.one_of(st.none(), st.just(float("nan")), st.integers(0, 9).map(float))


@FEW
@given(st.lists(st.tuples(NUMBERS, NUMBERS), max_size=30))
def test_quarantine(spark, pairs):
    df = spark.createDataFrame([(n, *p) for n, p in enumerate(pairs)], "n int, a double, b double")
    usable, rest = split_complete(df, ["a", "b"])

    def lacks(value):
        return value is None or math.isnan(value)

    missing = {
        n: [name for name, value in zip("ab", pair) if lacks(value)] for n, pair in enumerate(pairs)
    }
    assert {r.n for r in usable.collect()} == {n for n, m in missing.items() if not m}
    assert {r.n: r.missing for r in rest.collect()} == {n: m for n, m in missing.items() if m}
