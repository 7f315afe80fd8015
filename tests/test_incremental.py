"""Updates of the feature store: as a whole computation, partition by partition, all or nothing."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from pulseframe.operators.vitals import feature_table
from pulseframe.plans.analogs import event_log
from pulseframe.plans.incremental import FeatureStore
from pulseframe.sinks.manifest import Manifest


@pytest.fixture(scope="module")
def tables(spark, small):
    return event_log(spark, small, numbered=True)


def upto(tables, number):
    return replace(tables, chartevents=tables.chartevents.where(F.col("event_id") <= number))


def same(a, b):
    """Sums of doubles depend on the order of the readings in their last bits."""
    a, b = (df.withColumns({c: F.round(c, 9) for c, kind in df.dtypes if kind == "double"}) for df in (a, b))
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_three_updates_equal_the_whole(spark, tables, tmp_path):
    store = FeatureStore(str(tmp_path / "store"), "event_id", partitions=8)
    assert store.read(spark).count() == 0 and store.high_water(spark) == (0, None)
    last = tables.chartevents.agg(F.max("event_id")).first()[0]
    for number in (last // 3, last // 2, last):
        done = store.update(upto(tables, number))
        assert same(store.read(spark), feature_table(upto(tables, number)))
        assert done.upto == store.high_water(spark)[1] <= number
    assert store.update(tables).version is None
    assert store.high_water(spark)[0] == 3


def test_untouched_partitions_stay(spark, tables, tmp_path):
    store = FeatureStore(str(tmp_path / "store"), "event_id", partitions=8)
    last = tables.chartevents.agg(F.max("event_id")).first()[0]
    store.update(upto(tables, last - 1))
    before = set(store.paths(spark))
    late = tables.chartevents.withColumns({"event_id": F.lit(last + 5).cast("long"), "itemid": F.lit(51), "error": F.lit(None).cast("string")})
    one = replace(tables, chartevents=late.where("hadm_id = 7").limit(1))
    done = store.update(one)
    assert len(done.parts) == 1
    after = set(store.paths(spark))
    assert len(before - after) <= 1 and len(before & after) >= len(before) - 1
    assert all("version=2" in p for p in after - before)


@pytest.mark.parametrize("first", [True, False])
def test_an_update_that_dies_is_repeated(spark, tables, tmp_path, monkeypatch, first):
    store = FeatureStore(str(tmp_path / "store"), "event_id", partitions=4)
    last = tables.chartevents.agg(F.max("event_id")).first()[0]
    if not first:
        store.update(upto(tables, last // 2))
    before = [tuple(r) for r in store.read(spark).orderBy("hadm_id", "charttime").collect()]

    def dies(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as broken:
        broken.setattr(Manifest, "add", dies)
        with pytest.raises(RuntimeError):
            store.update(tables)
    assert [tuple(r) for r in store.read(spark).orderBy("hadm_id", "charttime").collect()] == before
    store.update(tables)
    assert same(store.read(spark), feature_table(tables))
