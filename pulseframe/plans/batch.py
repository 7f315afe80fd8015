"""The batch job, from tables to predictions."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from pulseframe.operators.codes import all_codes, code_lists
from pulseframe.operators.extract import FEATURE_COLUMNS, clinical_extract
from pulseframe.operators.model import ForestSettings, feature_importances, train_and_evaluate
from pulseframe.operators.metrics import regression_metrics
from pulseframe.operators.quality import require_columns, validate
from pulseframe.operators.vitals import feature_table, preprocess_extract
from pulseframe.schemas import (
    BATCH_LABEL,
    CLINICAL_SCHEMAS,
    ITEM_CODE_TEXT,
    OBSERVATION_KEY,
    REQUIRED_VITALS,
    ClinicalTables,
)
from pulseframe.sinks.files import write_predictions
from pulseframe.staging import stage


@dataclass(frozen=True)
class BatchResult:
    features: DataFrame
    model: PipelineModel
    predictions: DataFrame
    metrics: DataFrame
    importances: DataFrame


def run_batch(
    tables: ClinicalTables,
    output: str | None = None,
    settings: ForestSettings = ForestSettings(),
    text: Mapping[str, str] = ITEM_CODE_TEXT,
    limit: int | None = None,
    handle_invalid: str = "error",
) -> BatchResult:
    """Features, forest, metrics and importances; predictions as CSV to `output`.

    `limit` keeps only the first readings in chart order; by default all count.
    """
    for name, schema in CLINICAL_SCHEMAS.items():
        require_columns(getattr(tables, name), schema.names, name)
    if limit is None:
        features = feature_table(tables, text)
    else:
        groups = code_lists(text)
        extract = clinical_extract(tables, all_codes(groups), limit).select(FEATURE_COLUMNS)
        features = preprocess_extract(stage(extract, "extract"), groups)
    features = stage(features, "features")
    validate(features, [*OBSERVATION_KEY, *REQUIRED_VITALS, "gender", "age"], "features")
    result = train_and_evaluate(features, settings, handle_invalid)
    # Written once for the file, the metrics and the caller; vectors are not needed any more.
    predictions = stage(result.predictions.drop("features"), "predictions")
    if output is not None:
        write_predictions(predictions, output)
    return BatchResult(
        features,
        result.model,
        predictions,
        regression_metrics(predictions, BATCH_LABEL),
        feature_importances(features.sparkSession, result.model),
    )
