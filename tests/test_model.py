from __future__ import annotations

import math

from dataclasses import replace

import pytest
from clinical import golden_tables, rows
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from pulseframe.operators import metrics, model, split
from pulseframe.operators.vitals import feature_table
from pulseframe.plans.batch import run_batch
from pulseframe.schemas import BATCH_FEATURES

FEW = model.ForestSettings(num_trees=5, max_depth=3)


@pytest.fixture(scope="module")
def observations(spark):
    """300 observations whose systolic pressure follows from the features."""
    n = F.col("id")
    return (
        spark.range(300)
        .select(
            n.alias("hadm_id"),
            F.timestamp_seconds(n * 3600).alias("charttime"),
            (n % 40 + 60.0).alias("diastolic_bp"),
            F.lit(None).cast("double").alias("map"),
            (n % 30 + 55.0).alias("heart_rate"),
            F.when(n % 3 == 0, "M").otherwise("F").alias("gender"),
            (n % 70 + 20.0).alias("age"),
        )
        .withColumn("systolic_bp", F.col("diastolic_bp") * 1.5 + F.col("heart_rate") * 0.1)
        .cache()
    )


@pytest.fixture(scope="module")
def evaluated(observations):
    return model.train_and_evaluate(observations, FEW)


def test_defaults(spark):
    settings = model.ForestSettings()
    assert (settings.num_trees, settings.max_depth, settings.seed) == (100, 5, 42)
    assert settings.train_ratio == 0.8
    grown = model.forest("y")
    assert grown.getNumTrees() == 100 and grown.getMaxDepth() == 5 and grown.getSeed() == 42


@pytest.mark.parametrize("metric", ["mae", "rmse", "r2"])
def test_metrics_equal_the_evaluator(evaluated, metric):
    ours = evaluated.metrics.first()[metric]
    judge = RegressionEvaluator(
        labelCol="systolic_bp", predictionCol="prediction", metricName=metric
    )
    assert ours == pytest.approx(judge.evaluate(evaluated.predictions), rel=1e-12)


def test_forest_learns(evaluated):
    result = evaluated.metrics.first()
    assert 20 < result.n_rows < 120
    assert result.r2 > 0.5


def test_importances(spark, evaluated):
    ranked = model.feature_importances(spark, evaluated.model).orderBy("rank").collect()
    assert sorted(r.feature for r in ranked) == sorted(BATCH_FEATURES)
    assert [r["rank"] for r in ranked] == [1, 2, 3, 4]
    assert ranked[0].feature == "diastolic_bp"
    weights = [r.importance for r in ranked]
    assert weights == sorted(weights, reverse=True)
    assert sum(weights) == pytest.approx(1.0)


def test_saved_model_predicts_the_same(observations, evaluated, tmp_path):
    path = str(tmp_path / "model")
    for _ in range(2):
        model.save_model(evaluated.model, path)
    again = model.load_model(path).transform(observations)
    first = evaluated.model.transform(observations)
    pick = ["hadm_id", "prediction"]
    assert rows(again.select(pick)) == rows(first.select(pick))


def test_index_by_frequency_then_alphabet(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "gender string")
    fitted = model.category_indexer().fit(df)
    assert list(fitted.labels) == ["c", "a", "b"]


def test_unseen_and_null_categories(spark):
    seen = spark.createDataFrame([("a",), ("b",), ("a",)], "gender string")
    other = spark.createDataFrame([("a",), ("z",), (None,)], "gender string")
    with pytest.raises(Exception, match="(?i)unseen|null"):
        model.category_indexer().fit(seen).transform(other).collect()
    skipped = model.category_indexer(handle_invalid="skip").fit(seen).transform(other)
    assert skipped.count() == 1
    kept = model.category_indexer(handle_invalid="keep").fit(seen).transform(other)
    assert [r.gender_index for r in kept.collect()] == [0.0, 2.0, 2.0]


def test_null_age_stops_the_default_assembler(spark):
    features = feature_table(golden_tables(spark))
    indexed = model.category_indexer().fit(features).transform(features)
    with pytest.raises(Exception, match="(?i)null"):
        model.assembler(BATCH_FEATURES).transform(indexed).collect()
    assert model.assembler(BATCH_FEATURES, handle_invalid="skip").transform(indexed).count() == 3


def test_constant_label_and_no_rows(spark):
    flat = spark.createDataFrame([(5.0, 4.0), (5.0, 6.0)], "y double, prediction double")
    assert metrics.regression_metrics(flat, "y").first().r2 == -math.inf
    exact = spark.createDataFrame([(5.0, 5.0)], "y double, prediction double")
    assert math.isnan(metrics.regression_metrics(exact, "y").first().r2)
    nothing = metrics.regression_metrics(flat.where("y < 0"), "y").first()
    assert (nothing.n_rows, nothing.mae, nothing.rmse, nothing.r2) == (0, None, None, None)


def test_mean_baseline_scores_zero_on_its_own_rows(observations):
    scored = metrics.score_with_mean(observations, observations, "systolic_bp")
    assert metrics.regression_metrics(scored, "systolic_bp").first().r2 == pytest.approx(0)


def test_key_split_is_a_disjoint_cover_and_ignores_partitioning(spark, observations):
    keys = ["hadm_id", "charttime"]
    train, test = split.key_split(observations, keys)
    ids = {r.hadm_id for r in train.collect()}, {r.hadm_id for r in test.collect()}
    assert not ids[0] & ids[1]
    assert ids[0] | ids[1] == set(range(300))
    assert 0.7 < len(ids[0]) / 300 < 0.9
    for partitions in (1, 5):
        again, _ = split.key_split(observations.repartition(partitions), keys)
        assert {r.hadm_id for r in again.collect()} == ids[0]
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        again, _ = split.key_split(observations, keys)
        assert {r.hadm_id for r in again.collect()} == ids[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    other, _ = split.key_split(observations, keys, seed=7)
    assert {r.hadm_id for r in other.collect()} != ids[0]


def test_null_keys_are_split_too(spark):
    df = spark.createDataFrame([(None, 1), (2, None), (None, None)], "a long, b long")
    train, test = split.key_split(df, ["a", "b"])
    assert train.count() + test.count() == 3


def test_random_split_repeats_on_the_same_partitions(observations):
    first = [part.count() for part in split.random_split(observations)]
    assert sum(first) == 300
    assert [part.count() for part in split.random_split(observations)] == first


def test_training_rows_are_placed_by_their_values(spark):
    copies = spark.range(20_000).select(F.lit(1.0).alias("x"), (F.col("id") % 3).alias("y"))

    def places(df):
        placed = model.placed_for_training(df, 3_000).withColumn("p", F.spark_partition_id())
        return placed.groupBy("p").agg(F.collect_list("y").alias("ys")).orderBy("p").collect()

    first = places(copies.coalesce(1))
    assert first == places(copies.repartition(7, F.rand(3)))
    assert len(first) == 7 and max(len(r.ys) for r in first) < 3_500


def test_model_depends_on_rows_and_settings_only(spark, readings):
    some = replace(FEW, rows_per_task=60)
    forests = [
        model.fit(model.sensor_pipeline(some), readings.repartition(n, F.rand(n)), some) for n in (1, 7)
    ]
    scores = [
        [r[t] for r in f.transform(readings).orderBy("PTT", "PIR", "HR").collect() for t in ("Predicted_SBP", "Predicted_DBP")]
        for f in forests
    ]
    assert scores[0] == pytest.approx(scores[1])


@pytest.fixture(scope="module")
def readings(spark):
    n = F.col("id")
    return spark.range(200).select(
        (n % 10 / 10).cast("float").alias("PTT"),
        (n % 7 / 7).cast("float").alias("PIR"),
        (n % 50 + 50).cast("float").alias("HR"),
        (n % 10 * 3 + 100).cast("float").alias("SBP"),
        (n % 7 * 2 + 60).cast("float").alias("DBP"),
    )


def test_equal_readings_stay_one_row_each(spark, readings):
    trained = model.train_dual_target(readings, FEW)
    same = spark.createDataFrame([(1.0, 2.0, 70.0)] * 3 + [(2.0, 2.0, 70.0)], "PTT float, PIR float, HR float")
    scored = model.score_sensors(trained.model, same)
    assert scored.columns == ["PTT", "PIR", "HR", "Predicted_SBP", "Predicted_DBP"]
    assert scored.count() == 4


def test_dual_target_metrics_equal_the_evaluator(readings):
    trained = model.train_dual_target(readings, FEW)
    ours = {r.target: r for r in trained.metrics.collect()}
    for target in ("SBP", "DBP"):
        judge = RegressionEvaluator(
            labelCol=target, predictionCol=f"Predicted_{target}", metricName="rmse"
        )
        assert ours[target].rmse == pytest.approx(judge.evaluate(trained.predictions))


def test_each_target_matches_a_forest_of_its_own(readings):
    both = model.sensor_pipeline(FEW).fit(readings.coalesce(1))
    vectors = model.assembler(["PTT", "PIR", "HR"]).transform(readings.coalesce(1))
    alone = model.forest("DBP", FEW).fit(vectors)
    expected = [r.prediction for r in alone.transform(vectors).collect()]
    assert [r.Predicted_DBP for r in both.transform(readings.coalesce(1)).collect()] == expected


def test_batch_job(spark, small, tmp_path):
    from pulseframe.plans.analogs import event_log

    out = str(tmp_path / "predictions")
    result = run_batch(event_log(spark, small), out, FEW, handle_invalid="skip")
    assert result.metrics.first().n_rows == result.predictions.count()
    assert result.importances.count() == 4
    back = spark.read.csv(out, header=True, inferSchema=True)
    assert back.columns == ["Systolic BP", "prediction"]
    assert back.count() == result.predictions.count()


def test_batch_job_with_a_limit_uses_the_first_readings(spark, small):
    from pulseframe.plans.analogs import event_log

    tables = event_log(spark, small)
    whole = run_batch(tables, settings=FEW, handle_invalid="skip").features
    enough = run_batch(tables, settings=FEW, limit=10_000_000, handle_invalid="skip").features
    some = run_batch(tables, settings=FEW, limit=600, handle_invalid="skip").features
    cells = [F.round(c, 9) if t == "double" else F.col(c) for c, t in whole.dtypes]
    assert rows(whole.select(cells)) == rows(enough.select(*whole.columns).select(cells))
    assert 0 < some.count() < whole.count()


def test_batch_job_without_observations(spark):
    from dataclasses import replace

    tables = golden_tables(spark)
    none = replace(tables, chartevents=tables.chartevents.where("itemid = 999"))
    with pytest.raises(ValueError, match="no rows"):
        run_batch(none)
    with pytest.raises(ValueError, match="chartevents lacks columns .*valuenum"):
        run_batch(replace(tables, chartevents=tables.chartevents.drop("valuenum")))
