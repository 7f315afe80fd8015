from __future__ import annotations

import pytest
from clinical import rows
from pyspark.sql import functions as F

from pulseframe.operators import joins
from pulseframe.operators.extract import stays_are_small
from pulseframe.operators.vitals import feature_table
from pulseframe.plans.analogs import late_skewed_order_history, order_history


@pytest.fixture(scope="module")
def skewed(spark):
    """12,000 facts; a third and a few more belong to key 7."""
    return spark.range(12_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("key"),
        F.col("id").alias("n"),
    )


@pytest.fixture(scope="module")
def dims(spark):
    return spark.range(900).select(F.col("id").alias("key"), (F.col("id") * 2).alias("twice"))


def test_a_third_of_the_rows_is_found(skewed):
    hot = joins.frequent_keys(skewed, "key")
    assert set(hot) == {7}
    assert hot[7] == pytest.approx(1 / 3, abs=0.01)


def test_even_keys_are_not_hot(spark):
    even = spark.range(10_000).select((F.col("id") % 500).alias("key"))
    assert joins.frequent_keys(even, "key") == {}
    assert joins.frequent_keys(even.where("key < 0"), "key") == {}


def test_all_three_forms_agree(skewed, dims):
    plain = rows(skewed.join(dims, "key"), "n")
    salted = joins.join_by_key(skewed, dims, "key", spread_by=["n"], broadcast_bytes=0)
    small = joins.join_by_key(skewed, dims, "key", spread_by=["n"])
    even = skewed.where("key <> 7")
    shuffled = joins.join_by_key(even, dims, "key", spread_by=["n"], broadcast_bytes=0)
    assert salted.columns == small.columns == ["key", "n", "twice"]
    assert rows(salted, "n") == plain
    assert rows(small, "n") == plain
    assert rows(shuffled, "n") == [r for r in plain if r[0] != 7]


def test_repeated_dimension_rows_and_null_keys(spark, skewed):
    twice = spark.createDataFrame([(7, "a"), (7, "b"), (None, "c")], "key long, name string")
    facts = skewed.union(spark.createDataFrame([(None, -1)], "key long, n long"))
    salted = joins.join_by_key(facts, twice, "key", spread_by=["n"], broadcast_bytes=0)
    assert rows(salted, "n", "name") == rows(facts.join(twice, "key"), "n", "name")


@pytest.fixture
def shuffled_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def _hot_sizes(joined):
    where = joined.where("key = 7").select(F.spark_partition_id().alias("p"))
    return [r["count"] for r in where.groupBy("p").count().collect()]


def test_hot_rows_reach_many_partitions(skewed, dims, shuffled_joins):
    assert len(_hot_sizes(skewed.join(dims, "key"))) == 1
    salted = joins.join_by_key(skewed, dims, "key", spread_by=["n"], broadcast_bytes=0)
    sizes = _hot_sizes(salted)
    assert len(sizes) >= 3 and max(sizes) < 4_000 * 0.75


def test_exact_copies_are_spread_too(skewed, dims, shuffled_joins):
    copies = skewed.select("key", F.lit(1).alias("n"))
    numbered = joins.numbered(copies)
    salted = joins.join_by_key(
        numbered, dims, "key", spread_by=[joins.ROW], broadcast_bytes=0
    )
    sizes = _hot_sizes(salted)
    assert sum(sizes) == copies.where("key = 7").count()
    assert len(sizes) >= 3 and max(sizes) < 4_000 * 0.75


def test_feature_table_with_a_hot_admission(spark, small):
    """A third of the readings belong to one admission; both forms give the same rows."""
    from dataclasses import replace

    tables = order_history(spark, small)
    events = tables.chartevents
    hot = events.withColumn(
        "hadm_id", F.when(F.xxhash64("hadm_id", "itemid") % 3 == 0, 5).otherwise(F.col("hadm_id"))
    )
    skewed = replace(tables, chartevents=hot)
    assert 5 in joins.frequent_keys(hot, "hadm_id")
    small_form = feature_table(skewed)
    large_form = feature_table(skewed, broadcast_bytes=0)
    assert rows(large_form, "hadm_id", "charttime") == rows(small_form, "hadm_id", "charttime")


def test_size_estimate_grows_with_the_table(spark, small):
    tables = order_history(spark, small)
    assert joins.fits_broadcast([tables.patients])
    assert not joins.fits_broadcast([tables.patients], limit=100)
    assert joins.estimated_bytes(tables.chartevents) > joins.estimated_bytes(tables.patients)


def test_repeated_patients_are_never_broadcast(spark, small):
    from dataclasses import replace

    tables = order_history(spark, small)
    assert stays_are_small(tables)
    assert not stays_are_small(tables, limit=100)
    repeated = replace(tables, patients=tables.patients.union(tables.patients))
    assert not stays_are_small(repeated)
    ours, theirs = feature_table(repeated), feature_table(tables)
    assert rows(ours, "hadm_id", "charttime") == rows(theirs, "hadm_id", "charttime")


def test_keys_hot_only_among_the_joined_rows(spark, small, shuffled_joins):
    """Rare in the raw readings, dominant among the complete observations: spread all the same."""
    tables = late_skewed_order_history(spark, small)
    assert joins.frequent_keys(tables.chartevents, "hadm_id") == {}
    large = feature_table(tables, broadcast_bytes=0)
    assert rows(large, "hadm_id", "charttime") == rows(feature_table(tables), "hadm_id", "charttime")
    share = large.where("hadm_id = 5").count() / large.count()
    sizes = [r["count"] for r in large.groupBy(F.spark_partition_id()).count().collect()]
    assert share > 0.5 and max(sizes) < 0.6 * sum(sizes) and len(sizes) >= 3


def test_share_of_a_hot_key_follows_the_bytes(spark, small):
    readings = spark.read.parquet(f"{small}/lineitem.parquet")
    size = joins.estimated_bytes(readings)
    assert joins.hot_share(readings) == 1 / 8
    assert joins.hot_share(readings, task_bytes=size // 100) == pytest.approx(0.01, rel=0.1)
    assert joins.hot_share(readings, task_bytes=0) == 1 / joins.MOST_HOT_KEYS


def test_several_keys_in_one_pass(skewed):
    both = joins.frequent_keys_of(skewed.withColumn("n", F.lit(None).cast("long")), ["key", "n"])
    assert set(both["key"]) == {7} and both["n"] == {}
