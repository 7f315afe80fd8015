from __future__ import annotations

import os

import pytest
from clinical import golden_tables, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulseframe import staging
from pulseframe.operators.joins import fits_broadcast
from pulseframe.operators.vitals import feature_table
from pulseframe.schemas import CHARTEVENTS
from pulseframe.sinks.files import preview, read_batches, write_batch, write_csv
from pulseframe.sources.jdbc import (
    JdbcConnection,
    modulus_slices,
    range_slices,
    read_clinical_jdbc,
    read_jdbc,
    slice_number,
)
from pulseframe.sources.tables import read_clinical_tables, stream_table


def test_jdbc_connection():
    plain = JdbcConnection("db.example", "clinic", "me", "secret")
    assert plain.url == "jdbc:postgresql://db.example:5432/clinic"
    assert plain.properties == {
        "user": "me",
        "password": "secret",
        "driver": "org.postgresql.Driver",
        "fetchsize": "10000",
    }
    strict = JdbcConnection("h", "d", "u", "p", port=6000, ssl_mode="prefer")
    assert strict.url == "jdbc:postgresql://h:6000/d?sslmode=prefer"
    given_url = JdbcConnection("h", "d", "u", "p", explicit_url="jdbc:other:x")
    assert given_url.url == "jdbc:other:x"


class _Reader:
    """Stands in for spark.read: keeps the arguments, returns a ready table."""

    def __init__(self, tables):
        self.tables, self.calls = tables, []

    @property
    def read(self):
        return self

    def jdbc(self, url, table, predicates, properties):
        self.calls.append((url, table, predicates, properties["driver"]))
        return self.tables[table]


def test_jdbc_reads_one_table_each_in_slices(spark):
    golden = golden_tables(spark)
    by_name = {n: getattr(golden, n) for n in ("patients", "admissions", "chartevents", "d_items")}
    by_name["chartevents"] = by_name["chartevents"].withColumn("hadm_id", F.col("hadm_id").cast("int"))
    reader = _Reader(by_name)
    connection = JdbcConnection("h", "d", "u", "p")
    slices = range_slices("hadm_id", 100, 300, 4)
    tables = read_clinical_jdbc(reader, connection, {"chartevents": slices})
    assert [c[:3] for c in reader.calls] == [
        (connection.url, "patients", ["1 = 1"]),
        (connection.url, "admissions", ["1 = 1"]),
        (connection.url, "chartevents", slices),
        (connection.url, "d_items", ["1 = 1"]),
    ]
    assert tables.chartevents.schema == CHARTEVENTS
    assert feature_table(tables).count() == 4
    assert read_jdbc(reader, connection, "patients") is golden.patients


@settings(max_examples=300, deadline=None)
@given(st.integers(-50, 50), st.integers(0, 100), st.integers(1, 12))
def test_range_slices_are_contiguous(lower, width, slices):
    clauses = range_slices("k", lower, lower + width, slices)
    assert 1 <= len(clauses) <= slices

    def hits(value):
        return sum(
            bool(eval(c.replace("IS NULL", "is None").replace("AND", "and").replace("OR", "or")
                      .replace("1 = 1", "True"), {"k": value}))
            for c in clauses
        )

    assert {hits(v) for v in range(lower - 3, lower + width + 4)} == {1}


@pytest.mark.parametrize(
    "slices",
    [
        range_slices("a", -20, 20, 7),
        modulus_slices(["a"], 5),
        modulus_slices(["a", "b"], 8),
        range_slices("a", 3, 3, 4),
        range_slices("a", 3, 4, 4),
        range_slices("a", 3, 5, 4),
    ],
)
def test_slices_take_every_row_once(spark, slices):
    df = spark.range(200).select(
        F.when(F.col("id") % 9 != 0, F.col("id") - 100).alias("a"), (F.col("id") * 7 - 300).alias("b")
    )
    hits = sum(F.coalesce(F.expr(c), F.lit(False)).cast("int") for c in slices)
    assert [r[0] for r in df.select(hits.alias("h")).distinct().collect()] == [1]
    assert df.where(slice_number(slices).isNull()).isEmpty()


def test_modulus_slices_split_one_admission(spark):
    one = spark.range(1000).select(F.lit(5).alias("hadm_id"), F.col("id").alias("row_id"))
    parts = one.groupBy(slice_number(modulus_slices(["hadm_id", "row_id"], 10))).count()
    assert [r["count"] for r in parts.collect()] == [100] * 10


def test_clinical_tables_from_files(spark, tmp_path):
    golden = golden_tables(spark)
    for name in ("patients", "admissions", "chartevents", "d_items"):
        getattr(golden, name).write.parquet(str(tmp_path / name))
    tables = read_clinical_tables(spark, str(tmp_path))
    assert rows(feature_table(tables)) == rows(feature_table(golden))


def test_landed_tables_have_known_sizes(spark):
    golden = golden_tables(spark)
    assert not fits_broadcast([golden.d_items])
    landed = staging.land(golden)
    assert fits_broadcast([landed.d_items, landed.admissions, landed.patients])
    assert rows(feature_table(landed)) == rows(feature_table(golden))


def test_stream_of_a_file_or_folder(spark, small, tmp_path):
    table = spark.read.parquet(f"{small}/events.parquet")
    table.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    for base in (small, str(tmp_path)):
        stream = stream_table(spark, base, "events").select("event_id")
        query = (
            stream.writeStream.format("memory").queryName("one_or_many")
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        assert spark.table("one_or_many").count() == table.count()


def test_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, 1.5, None), (2, None, "x,y")], "a int, b double, c string")
    path = str(tmp_path / "csv")
    for single in (False, True):
        write_csv(df.repartition(3), path, single_file=single)
        assert rows(spark.read.schema(df.schema).csv(path, header=True), "a") == rows(df, "a")
    assert len(list((tmp_path / "csv").glob("part-*.csv"))) == 1


def test_batches(spark, tmp_path):
    path = str(tmp_path / "b")
    write_batch(spark.range(3), path, 0)
    write_batch(spark.range(2), path, 1)
    write_batch(spark.range(5), path, 0)
    back = read_batches(spark, path, "id long")
    assert rows(back.groupBy("batch_id").count()) == [(0, 5), (1, 2)]


def test_preview(spark):
    assert preview(spark.range(50)).count() == 10
    assert preview(spark.range(3)).count() == 3


def test_staged_table(spark):
    df = spark.range(10).withColumn("v", F.array(F.col("id")))
    staged = staging.stage(df, "numbers")
    assert staged.dtypes == df.dtypes
    assert rows(staged, "id") == rows(df, "id")
    assert spark.conf.get("spark.checkpoint.dir") in staged.inputFiles()[0]


def test_persisted_leaves_the_callers_cache_alone(spark):
    df = spark.range(100).where("id > 3")
    with staging.persisted(df) as kept:
        assert kept.storageLevel.useMemory and kept.count() == 96
    assert not df.storageLevel.useMemory
    df.persist()
    with staging.persisted(df):
        pass
    assert df.storageLevel.useMemory
    df.unpersist()


def test_work_dir_refuses_local_folders_on_a_cluster():
    class Session:
        def __init__(self, master):
            self.conf = {}
            self.sparkContext = type("C", (), {"master": master, "applicationId": f"app-{master}"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.work_dir(Session("yarn"), "x")
    local = Session("local[2]")
    first, second = staging.work_dir(local, "x"), staging.work_dir(local, "x")
    assert first != second
    assert first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0] and not local.conf


def test_staged_tables_are_removed(spark):
    with staging.staged(spark.range(5), "short") as table:
        path = table.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
        assert table.count() == 5 and os.path.isdir(path)
    assert not os.path.exists(path)
    with pytest.raises(ZeroDivisionError), staging.staged(spark.range(5), "short") as table:
        path = table.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
        raise ZeroDivisionError
    assert not os.path.exists(path)


def test_filters_reach_a_source_of_other_types(spark, small, tmp_path):
    """A Parquet stand-in for a database with wide codes, numeric flags and single-precision values."""
    from pyspark.sql import functions as F

    from pulseframe.operators.codes import all_codes, code_lists
    from pulseframe.operators.extract import valid_readings
    from pulseframe.plans.analogs import order_history
    from pulseframe.sources.jdbc import typed_tables

    tables = order_history(spark, small)
    path = str(tmp_path / "chartevents")
    tables.chartevents.withColumns(
        {"itemid": F.col("itemid").cast("long"), "error": F.col("error").cast("int"), "valuenum": F.col("valuenum").cast("float")}
    ).write.parquet(path)
    raw = {name: getattr(tables, name) for name in ("patients", "admissions", "d_items")}
    codes = all_codes(code_lists())
    found = typed_tables({**raw, "chartevents": spark.read.parquet(path)}, codes).chartevents
    assert found.schema["itemid"].dataType == tables.chartevents.schema["itemid"].dataType
    plan = found._jdf.queryExecution().executedPlan().toString()
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "In(itemid" in pushed and "IsNull(error)" in pushed and "IsNotNull(valuenum)" in pushed
    assert found.count() == valid_readings(tables.chartevents, codes).count()


def test_a_single_file_is_written_after_the_steps_above_ran_in_parallel(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("single-file", "single-file")
    try:
        counts = spark.range(0, 10_000, 1, 4).groupBy((F.col("id") % 100).alias("g")).count()
        write_csv(counts, str(tmp_path / "csv"), single_file=True)
        stages = [s for j in tracker.getJobIdsForGroup("single-file") for s in tracker.getJobInfo(j).stageIds]
        tasks = sorted(tracker.getStageInfo(s).numTasks for s in stages)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.unset("spark.sql.adaptive.enabled")
    # The aggregate runs in as many tasks as there are shuffle partitions; only the writing is one task.
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) in tasks and tasks[0] == 1
    back = spark.read.csv(str(tmp_path / "csv"), header=True)
    assert back.count() == 100 and back.select(F.input_file_name()).distinct().count() == 1
