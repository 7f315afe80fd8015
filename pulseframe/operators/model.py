"""Random forests on MLlib: pipelines, training, importances, persistence."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulseframe.functions import portable_bucket
from pulseframe.operators.metrics import regression_metrics
from pulseframe.operators.split import key_split
from pulseframe.schemas import (
    BATCH_FEATURES,
    BATCH_LABEL,
    OBSERVATION_KEY,
    SENSOR_FEATURES,
    SENSOR_TARGETS,
)
from pulseframe.staging import persisted



@dataclass(frozen=True)
class ForestSettings:
    """Settings of the forests; the seed also drives the split.

    The same rows and settings give the same forest on any cluster. `rows_per_task` is part of that: it
    decides how many partitions the training rows are placed in, and MLlib draws its samples per
    partition. Training keeps one count per tree beside every row, about 800 bytes at 100 trees;
    `subsampling_rate` bounds what a tree sees of a very large table.
    """

    # The defaults of the original job.
    num_trees: int = 100
    max_depth: int = 5
    seed: int = 42
    train_ratio: float = 0.8
    # MLlib's own defaults.
    bootstrap: bool = True
    subsampling_rate: float = 1.0
    feature_subset: str = "auto"
    max_bins: int = 32
    rows_per_task: int = 10_000


@dataclass(frozen=True)
class Evaluated:
    model: PipelineModel
    predictions: DataFrame
    metrics: DataFrame


def category_indexer(
    column: str = "gender", output: str = "gender_index", handle_invalid: str = "error"
) -> StringIndexer:
    """Most frequent category is 0, ties alphabetical."""
    return StringIndexer(
        inputCol=column,
        outputCol=output,
        handleInvalid=handle_invalid,
        stringOrderType="frequencyDesc",
    )


def assembler(
    columns: Sequence[str], output: str = "features", handle_invalid: str = "error"
) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=handle_invalid)


def forest(
    label: str, settings: ForestSettings = ForestSettings(), prediction: str = "prediction"
) -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol="features",
        labelCol=label,
        predictionCol=prediction,
        numTrees=settings.num_trees,
        maxDepth=settings.max_depth,
        seed=settings.seed,
        bootstrap=settings.bootstrap,
        subsamplingRate=settings.subsampling_rate,
        featureSubsetStrategy=settings.feature_subset,
        maxBins=settings.max_bins,
    )


def pressure_pipeline(
    settings: ForestSettings = ForestSettings(), handle_invalid: str = "error"
) -> Pipeline:
    """Index gender, assemble the clinical features, predict systolic pressure.

    `handle_invalid` covers unseen or NULL genders and NULL ages: error, skip
    or keep.
    """
    return Pipeline(
        stages=[
            category_indexer(handle_invalid=handle_invalid),
            assembler(BATCH_FEATURES, handle_invalid=handle_invalid),
            forest(BATCH_LABEL, settings),
        ]
    )


def placed_for_training(df: DataFrame, rows_per_task: int) -> DataFrame:
    """The rows in partitions, and in an order within them, that only the rows decide.

    A row goes to the partition that its hash names. Copies of a row are counted, numbered and hashed
    with their number, so that they are spread too; which copy is which does not matter.
    """
    columns = [F.col(name) for name in df.columns]
    tasks = max(1, math.ceil(df.count() / rows_per_task))
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    numbered = counted.select(
        *columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy")
    )
    placed = numbered.repartition(tasks, *columns, F.col("_copy"))
    return placed.sortWithinPartitions(*columns).drop("_copy")


def fit(
    pipeline: Pipeline, train: DataFrame, settings: ForestSettings = ForestSettings()
) -> PipelineModel:
    """Fit on a placed copy, kept in memory or on disk while the stages pass over it."""
    with persisted(placed_for_training(train, settings.rows_per_task)) as placed:
        return pipeline.fit(placed)


def train_and_evaluate(
    features: DataFrame,
    settings: ForestSettings = ForestSettings(),
    handle_invalid: str = "error",
    keys: Sequence[str] = tuple(OBSERVATION_KEY),
) -> Evaluated:
    """Fit on the training part, score and measure the held-out part.

    The features are read several times: hand in a staged table.
    """
    train, test = key_split(features, keys, settings.train_ratio, settings.seed)
    model = fit(pressure_pipeline(settings, handle_invalid), train, settings)
    predictions = model.transform(test)
    return Evaluated(model, predictions, regression_metrics(predictions, BATCH_LABEL))


def sensor_pipeline(
    settings: ForestSettings = ForestSettings(), features: Sequence[str] = tuple(SENSOR_FEATURES)
) -> Pipeline:
    """Assemble once, then both forests in a chain.

    Each forest adds its own column to the same row, so two predictions meet
    without a join and the row count cannot change.
    """
    return Pipeline(
        stages=[
            assembler(features),
            forest("SBP", settings, prediction="Predicted_SBP"),
            forest("DBP", settings, prediction="Predicted_DBP"),
        ]
    )


def train_dual_target(
    readings: DataFrame,
    settings: ForestSettings = ForestSettings(),
    keys: Sequence[str] | None = None,
    features: Sequence[str] = tuple(SENSOR_FEATURES),
) -> Evaluated:
    """Systolic and diastolic forests over one split; metrics has one row per target.

    Readings carry no key of their own, so by default the split hashes the
    whole reading and copies of a reading stay on one side.
    """
    columns = list(keys or [*SENSOR_FEATURES, *SENSOR_TARGETS])
    train, test = key_split(readings, columns, settings.train_ratio, settings.seed)
    model = fit(sensor_pipeline(settings, features), train, settings)
    predictions = model.transform(test)
    return Evaluated(model, predictions, dual_target_metrics(predictions))


def dual_target_metrics(scored: DataFrame) -> DataFrame:
    """One row per target, both from a single pass over the scored readings."""
    pairs = [
        F.struct(
            F.lit(target).alias("target"),
            F.col(target).cast("double").alias("label"),
            F.col(f"Predicted_{target}").alias("prediction"),
        )
        for target in SENSOR_TARGETS
    ]
    return regression_metrics(scored.select(F.inline(F.array(*pairs))), "label", by=["target"])


def score_sensors(model: PipelineModel, readings: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """`keep` columns, the features and both predictions; static or streaming."""
    return model.transform(readings).select(
        *keep, *SENSOR_FEATURES, "Predicted_SBP", "Predicted_DBP"
    )


def feature_importances(
    spark: SparkSession, model: PipelineModel, names: Sequence[str] = tuple(BATCH_FEATURES)
) -> DataFrame:
    """(rank, feature, importance), highest first; as many rows as features."""
    weights = [float(w) for w in model.stages[-1].featureImportances.toArray()]
    ranked = sorted(zip(names, weights, strict=True), key=lambda pair: (-pair[1], pair[0]))
    rows = [(place, name, weight) for place, (name, weight) in enumerate(ranked, start=1)]
    return spark.createDataFrame(rows, "rank int, feature string, importance double")


def permuted(df: DataFrame, columns: Sequence[str], keys: Sequence[str], seed: int, rows_per_group: int = 10_000) -> DataFrame:
    """`df` with a struct `_other` of the columns' values of another row: the next one in hash order.

    Rows are dealt into groups by a hash of their key, and the last row of a group takes the first one's values, so each
    value occurs as often as before and no task sorts more than a group.
    """
    groups = max(1, math.ceil(df.count() / rows_per_group))
    names = [F.col(key) for key in keys]
    text = F.concat_ws("|", F.lit(str(seed)), *[name.cast("string") for name in names])
    mine = Window.partitionBy("_group").orderBy("_place", *names)
    values = F.struct(*columns)
    whole = mine.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    other = F.coalesce(F.lead(values).over(mine), F.first(values).over(whole))
    dealt = df.withColumn("_group", portable_bucket(names, seed, groups)).withColumn("_place", F.md5(text))
    return dealt.withColumn("_other", other).drop("_group", "_place")


def permutation_importances(
    model: PipelineModel,
    df: DataFrame,
    label: str,
    features: Sequence[str],
    keys: Sequence[str],
    prediction: str = "prediction",
    seed: int = 42,
) -> DataFrame:
    """(rank, feature, mse, importance): how much the mean squared error grows if a feature's values change places.

    Every row is repeated once for each feature, with this feature of another row, and once as it is; all are scored in
    one pass and measured by one aggregation. Unlike the trees' own importances it can be taken on rows that did
    not train the model.
    """
    variants = []
    for changed in [None, *features]:
        values = [(F.col(f"_other.{f}") if f == changed else F.col(f)).alias(f) for f in features]
        variants.append(F.struct(F.lit(changed or "").alias("feature"), *values))
    mixed = permuted(df.select(*dict.fromkeys([*keys, label, *features])), features, keys, seed)
    rows = mixed.select(F.col(label).cast("double").alias("_label"), F.inline(F.array(*variants)))
    errors = model.transform(rows).groupBy("feature").agg(F.avg((F.col("_label") - F.col(prediction)) ** 2).alias("mse"))
    # As many rows as features from here on, and one.
    base = F.max(F.when(F.col("feature") == "", F.col("mse"))).over(Window.partitionBy(F.lit(1)))
    grown = errors.select("feature", "mse", (F.col("mse") - base).alias("importance")).where("feature <> ''")
    place = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("importance"), "feature"))
    return grown.select(place.alias("rank"), "feature", "mse", "importance")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
