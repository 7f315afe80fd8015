"""Counts taken on the way, reasons for rejection, groups kept together, even slices, bounds from sketches."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from pulseframe.operators import extract, quality, split, vitals
from pulseframe.operators.codes import all_codes, code_lists
from pulseframe.plans.analogs import order_history
from pulseframe.sources import jdbc
from pulseframe.streaming.parse import explain_messages, split_by_reasons
from pulseframe.streaming.runs import RecordListener, counted, drain, named_writer, observed_records


def test_observed_steps_take_no_job(spark, small):
    groups = code_lists()
    classified = vitals.classify(extract.valid_readings(order_history(spark, small).chartevents, all_codes(groups)), groups)
    expected = quality.step_counts(classified).first().asDict()
    features, seen = quality.observed_steps(classified)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("observed", "observed")
    try:
        n = len(features.collect())
        jobs = len(tracker.getJobIdsForGroup("observed"))
        assert quality.steps_seen(seen) == expected and n == expected["n_complete"]
        assert len(tracker.getJobIdsForGroup("observed")) == jobs
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_stream_counts_by_progress_and_listener(spark, tmp_path):
    for part, n in enumerate((3, 5)):
        spark.range(n).coalesce(1).write.parquet(str(tmp_path / "in" / str(part)))
    listener = RecordListener()
    spark.streams.addListener(listener)
    try:
        stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
        writer = named_writer(counted(stream), "watched", str(tmp_path / "checkpoints")).format("parquet").option("path", str(tmp_path / "out"))
        query = drain(writer)
        assert sorted(observed_records(query).values()) == [3, 5]
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
        assert Counter(listener.batches.values()) == Counter([3, 5]) and {name for name, _ in listener.batches} == {"watched"}
    finally:
        spark.streams.removeListener(listener)


@pytest.mark.parametrize(
    "text, reasons",
    [
        ('{"PTT":1,"PIR":2.5,"HR":70}', []),
        ('{"PTT":1,"PIR":2.5,"HR":70,"more":[1,{"x":2}]}', []),
        ("bad", ["*:not json"]),
        ("", ["*:not json"]),
        (None, ["*:not json"]),
        ("[1,2]", ["*:not json"]),
        ('{"PTT":1,"PIR":2.5,"HR":70', ["*:not json"]),
        ('{"PTT":"x","PIR":2.5,"HR":70}', ["PTT:wrong type"]),
        ('{"PTT":{"a":1},"PIR":2.5,"HR":[70]}', ["PTT:wrong type", "HR:wrong type"]),
        ('{"ptt":1,"Pir":2.5,"HR":70}', ["PTT:wrong case", "PIR:wrong case"]),
        ('{"HR":null}', ["PTT:missing", "PIR:missing", "HR:missing"]),
    ],
)
def test_reasons(spark, text, reasons):
    df = spark.createDataFrame([(1, None if text is None else text.encode())], "id long, value binary")
    row = explain_messages(df, keep=["id"]).first()
    assert [f"{r['field']}:{r['reason']}" for r in row["reasons"]] == reasons
    assert row["raw"] == (None if text is None else text.encode())
    usable, rejected = split_by_reasons(explain_messages(df, keep=["id"]))
    assert (usable.count(), rejected.count()) == ((1, 0) if not reasons else (0, 1))
    assert rejected.columns == ["id", "reasons", "raw"]


@pytest.mark.parametrize("ratio", [0.0, 0.31, 0.8, 1.0])
def test_grouped_split_is_exact(spark, ratio):
    df = spark.createDataFrame([(g, i) for g in range(37) for i in range(1 if g else 40)] + [(None, 1)], "g long, i long")
    train, test = split.grouped_split(df, "g", ratio, 7)
    mine, theirs = ({r["g"] for r in part.select("g").distinct().collect()} for part in (train, test))
    assert len(mine - {None}) == int(37 * ratio + 0.5) and not mine & theirs
    assert train.count() + test.count() == df.count()


def test_equal_hashes_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(split, "group_hash", lambda group, seed: (group % 3).cast("bigint"))
    train, _ = split.grouped_split(spark.range(10).withColumnRenamed("id", "g"), "g", 0.5)
    assert sorted(r["g"] for r in train.collect()) == [0, 1, 3, 6, 9]


def test_slices_follow_the_rows(spark):
    rows = spark.range(4000).select((F.col("id") * F.col("id") * F.col("id")).alias("k"))
    cuts = jdbc.quantile_cuts(rows, "k", 8)
    slices = jdbc.cut_slices("k", cuts)
    sizes = [r["n"] for r in rows.groupBy(jdbc.slice_number(slices).alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == 8 and sum(sizes) == 4000 and max(sizes) <= 1.1 * 500
    assert jdbc.cut_slices("k", []) == list(jdbc.WHOLE) and jdbc.quantile_cuts(rows.limit(0), "k", 8) == []
    hot = jdbc.cut_slices("k", jdbc.quantile_cuts(spark.range(100).select(F.lit(5).alias("k")), "k", 8))
    assert hot == ["k < 5 OR k IS NULL", "k >= 5"]


def test_the_databases_query_gives_the_same_kind_of_cuts():
    import duckdb

    con = duckdb.connect()
    con.sql("CREATE TABLE t AS SELECT i * i AS k FROM range(1000) r(i)")
    assert [r[0] for r in con.sql(jdbc.quantile_query("t", "k", 4)).fetchall()] == [250**2, 500**2, 750**2]


def test_key_bound_and_a_sketch_that_is_too_low(spark, monkeypatch):
    keys = spark.range(20_000).select((F.col("id") % 5000).alias("hadm_id"))
    bound = extract.key_bound(keys, "hadm_id", 2000)
    assert 480 <= bound <= 560
    assert extract.key_bound(keys, "hadm_id", 20_001) is None and extract.key_bound(keys.limit(0), "hadm_id", 1) is None
    bounds = iter([3, 400, None])
    monkeypatch.setattr(extract, "key_bound", lambda *_: next(bounds))
    rows = spark.range(0, 5000).select(F.col("id").alias("hadm_id"), F.current_timestamp().alias("charttime"), F.lit(1).alias("itemid"))
    assert [r["hadm_id"] for r in extract.first_in_chart_order(rows, 50).collect()] == list(range(50))


def test_quantile_slices_of_keys_whose_cube_passes_64_bits(spark, tmp_path):
    from pulseframe.plans.catalog import quantile_slices

    spark.range(3_000_000, 3_004_000).select(F.col("id").alias("o_orderkey")).write.parquet(str(tmp_path / "orders.parquet"))
    rows = {r["method"]: r for r in quantile_slices(spark, str(tmp_path)).collect()}
    assert {m: (r["n_rows"], r["n_taken_once"]) for m, r in rows.items()} == {"range": (4000, 4000), "quantile": (4000, 4000)}
    assert rows["quantile"]["even"]
