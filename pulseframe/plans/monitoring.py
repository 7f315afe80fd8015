"""The streaming job: messages in, scored pressures out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from pulseframe.operators.model import score_sensors
from pulseframe.operators.quality import split_complete
from pulseframe.schemas import SENSOR_FEATURES
from pulseframe.sinks.files import write_batch
from pulseframe.streaming.models import ModelStore
from pulseframe.streaming.parse import parse_messages
from pulseframe.streaming.runs import named_writer
from pulseframe.streaming.scoring import BatchWriter, StreamTraining, scoring_handler


def scored_stream(
    messages: DataFrame, model: PipelineModel, keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """(scored, rejected) as streams, for any sink: nothing but per-row expressions."""
    usable, rejected = split_complete(parse_messages(messages, keep), SENSOR_FEATURES)
    return score_sensors(model, usable, keep), rejected


def monitor(
    messages: DataFrame,
    name: str,
    root: str,
    models: ModelStore,
    keep: Sequence[str] = (),
    train_with: StreamTraining | None = None,
    write: BatchWriter = write_batch,
) -> DataStreamWriter:
    """Writer that scores each micro-batch into `root`/scored and `root`/rejected, by `write`.

    In the steady state a model trained on tables is published beforehand; `train_with` is for a start
    without one.
    """
    handler = scoring_handler(
        f"{root}/scored", f"{root}/rejected", models, keep, train_with, f"{root}/waiting", write
    )
    return named_writer(parse_messages(messages, keep), name, f"{root}/checkpoints").foreachBatch(
        handler
    )
