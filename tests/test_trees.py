"""Forests as node tables and expressions, against the model; importances by permutation."""

from __future__ import annotations

import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import functions as F

from pulseframe.operators import model, trees

COLUMNS = "id long, diastolic_bp double, heart_rate double, gender string, age double, systolic_bp double"


@pytest.fixture(scope="module")
def observations(spark):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        sex, age = rng.choice(["F", "M", "X"]), rng.choice([None, *map(float, range(20, 90))])
        rows.append((i, rng.uniform(50, 100), float(rng.randrange(50, 120)), sex, age, rng.uniform(90, 180) + (20 if sex == "X" else 0)))
    rows += [(900, 70.0, float("nan"), "F", 40.0, 120.0), (901, None, 80.0, "M", 41.0, 121.0)]
    return spark.createDataFrame(rows, COLUMNS)


def scores(df):
    return sorted((r["id"], r["prediction"]) for r in df.select("id", "prediction").collect())


@pytest.mark.parametrize("invalid", ["skip", "keep"])
def test_equal_to_the_model(observations, invalid):
    settings = model.ForestSettings(num_trees=12, max_depth=4)
    train = observations.where("id < 400 AND age IS NOT NULL")
    fitted = model.fit(model.pressure_pipeline(settings, invalid), train.drop("id"), settings)
    unseen = observations.withColumn("gender", F.when(F.col("id") % 50 == 3, F.lit("new")).when(F.col("id") % 50 == 4, F.lit(None)).otherwise(F.col("gender")))
    assert scores(trees.score_by_expressions(fitted, unseen)) == scores(fitted.transform(unseen))


def test_errors_are_raised(observations):
    settings = model.ForestSettings(num_trees=1, max_depth=1)
    fitted = model.fit(model.pressure_pipeline(settings), observations.where("id < 400 AND age IS NOT NULL").drop("id"), settings)
    good = observations.where("id < 400 AND age IS NOT NULL")
    assert scores(trees.score_by_expressions(fitted, good)) == scores(fitted.transform(good))
    for bad in (observations.where("id = 901"), good.withColumn("gender", F.lit("new")), observations.where("age IS NULL")):
        with pytest.raises(Exception, match="missing|not seen"):
            trees.score_by_expressions(fitted, bad).collect()


def test_nodes_are_a_table(spark, observations):
    settings = model.ForestSettings(num_trees=3, max_depth=2)
    fitted = model.fit(model.pressure_pipeline(settings), observations.where("id < 400 AND age IS NOT NULL").drop("id"), settings)
    forest = fitted.stages[-1]
    nodes = trees.forest_nodes(spark, forest)
    assert nodes.count() == forest.totalNumNodes and nodes.select("tree").distinct().count() == 3
    assert nodes.where("feature IS NULL AND (left IS NOT NULL OR gain IS NOT NULL)").isEmpty()
    assert nodes.where("feature = 2 AND threshold IS NOT NULL").isEmpty()
    with pytest.raises(TypeError):
        trees.score_by_expressions(PipelineModel([Bucketizer(splits=[0, 1, 2])]), observations)


def test_scored_in_one_compiled_stage_and_on_streams(spark, observations, tmp_path):
    settings = model.ForestSettings(num_trees=2, max_depth=2)
    readings = observations.select("id", F.col("diastolic_bp").alias("PTT"), F.lit(1.0).alias("PIR"), F.col("heart_rate").alias("HR"), F.col("systolic_bp").alias("SBP"), F.col("age").alias("DBP"))
    readings = readings.dropna().where("NOT isnan(HR)")
    fitted = model.fit(model.sensor_pipeline(settings), readings.drop("id"), settings)
    scored = trees.score_by_expressions(fitted, readings)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan and "*(" in plan
    readings.write.parquet(str(tmp_path / "in"))
    stream = trees.score_by_expressions(fitted, spark.readStream.schema(readings.schema).parquet(str(tmp_path / "in")))
    stream.writeStream.format("memory").queryName("expressions").trigger(availableNow=True).start().awaitTermination(60)
    assert spark.table("expressions").exceptAll(scored).isEmpty() and spark.table("expressions").count() == scored.count()


def test_permuted_values_move_and_stay_the_same(spark):
    df = spark.createDataFrame([(i, float(i % 7), str(i)) for i in range(50)], "id long, x double, other string")
    mixed = model.permuted(df, ["x", "id"], ["id"], 3, rows_per_group=20).collect()
    assert sorted(r["_other"]["id"] for r in mixed) == list(range(50))
    assert all(r["_other"]["id"] != r["id"] for r in mixed)
    assert model.permuted(df.limit(0), ["x"], ["id"], 3).count() == 0
