"""Regression metrics, all from one aggregation pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(
    scored: DataFrame, label: str, prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """n_rows, mae, rmse, r2: one row, or one per group of `by`.

    r2 of a constant label is -Infinity (NaN if predicted exactly), as in
    RegressionEvaluator. No rows give n_rows 0 and NULL metrics.
    """
    y = F.col(label).cast("double")
    residual = y - F.col(prediction).cast("double")
    sums = scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(F.abs(residual)).alias("mae"),
        F.avg(residual * residual).alias("mse"),
        F.var_pop(y).alias("variance"),
    )
    flat = F.when(F.col("mse") == 0, F.lit(float("nan"))).otherwise(F.lit(float("-inf")))
    return sums.select(
        *by,
        "n_rows",
        "mae",
        F.sqrt("mse").alias("rmse"),
        F.when(F.col("variance") == 0, flat)
        .otherwise(1 - F.col("mse") / F.col("variance"))
        .alias("r2"),
    )


def score_with_mean(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """Test rows with the training mean as prediction: the floor a model must beat."""
    mean = train.agg(F.avg(label).alias("prediction"))
    return test.withColumn("prediction", mean.scalar())
