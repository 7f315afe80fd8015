"""foreachBatch handlers."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from pulseframe.operators.model import ForestSettings, fit, score_sensors, sensor_pipeline
from pulseframe.operators.quality import split_complete
from pulseframe.schemas import SENSOR_FEATURES, SENSOR_TARGETS
from pulseframe.sinks.files import write_batch
from pulseframe.staging import persisted, remove
from pulseframe.streaming.models import ModelStore

BatchHandler = Callable[[DataFrame, int], None]
#: write_batch replaces a batch's folder; commit_batch lists a new one when it is complete.
BatchWriter = Callable[[DataFrame, str, int], None]


def counting_handler(out: str, by: Sequence[str] = ()) -> BatchHandler:
    """Writes each batch's record count (per group of `by`); an empty batch adds no row.

    One action per batch: asking for emptiness first would read the source twice.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy(*by).agg(F.count(F.lit(1)).alias("n_records"))
        write_batch(counts.where(F.col("n_records") > 0), out, batch_id)

    return handle


def report_handler(
    report: Callable[[int, int, list[Row]], None], sample: int = 5
) -> BatchHandler:
    """Calls `report(batch_id, n_records, sample_rows)` for each non-empty batch."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        with persisted(batch) as rows:
            shown = rows.take(sample)
            if shown:
                report(batch_id, rows.count(), shown)

    return handle


@dataclass(frozen=True)
class StreamTraining:
    """How a stream trains the model it lacks.

    A batch trains if it has `least_rows` labelled readings; until then usable readings wait. Of more than
    `most_rows` about that many train, chosen by a hash of the reading: the bound on one fit.
    """

    settings: ForestSettings = ForestSettings()
    least_rows: int = 100
    most_rows: int = 10_000_000

    def see(self, usable: DataFrame, batch_id: int) -> None:
        """Called with every batch of usable readings until there is a model."""

    def model_from(self, usable: DataFrame) -> PipelineModel | None:
        labelled, _ = split_complete(usable, SENSOR_TARGETS)
        rows = labelled.count()
        if rows < max(self.least_rows, 1):
            return None
        if rows > self.most_rows:
            place = F.pmod(F.xxhash64(*SENSOR_FEATURES, *SENSOR_TARGETS), F.lit(1 << 30))
            labelled = labelled.where(place < int(self.most_rows / rows * (1 << 30)))
        return fit(sensor_pipeline(self.settings), labelled.select(*SENSOR_FEATURES, *SENSOR_TARGETS), self.settings)


#: Batch number under which readings that waited for a model are scored.
WAITED = -1


def scoring_handler(
    out: str,
    rejected: str,
    models: ModelStore,
    keep: Sequence[str] = (),
    train_with: StreamTraining | None = None,
    waiting: str | None = None,
    write: BatchWriter = write_batch,
) -> BatchHandler:
    """Scores both pressures of each usable reading into `out`.

    Unusable ones go to `rejected` with the names of what they lack. With `train_with`, a
    batch with enough labelled readings trains and publishes the model if none is
    published yet. Usable readings that arrive before any model go to `waiting`, by default a folder
    beside `rejected`; with the first batch that finds a model they are scored too, as batch WAITED. So
    every record ends up in exactly one of `out` and `rejected` once there is a model. What waited is scored
    once: then its folder goes. A version published later is used from the next batch on. `write` puts a
    batch into `out` and `rejected`.
    """
    waiting = waiting or f"{rejected.rstrip('/')}-waiting"
    held: dict[str, object] = {"version": None, "model": None, "waited": False}

    def current_model(usable: DataFrame) -> PipelineModel | None:
        spark = usable.sparkSession
        version = models.latest(spark)
        if version is None and train_with is not None:
            model = train_with.model_from(usable)
            if model is not None:
                models.publish(spark, model)
                version = models.latest(spark)
        if version is not None and version != held["version"]:
            held.update(version=version, model=models.load(version))
        return held["model"]

    def score_waiting(model: PipelineModel, like: DataFrame) -> None:
        """Once; if a run ends before the folder is gone, the next one writes the same rows in their place."""
        if held["waited"]:
            return
        spark = like.sparkSession
        try:
            rows = spark.read.schema(like.schema).option("recursiveFileLookup", "true").parquet(waiting)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        else:
            write(score_sensors(model, rows, keep), out, WAITED)
            remove(spark, waiting)
        held["waited"] = True

    def handle(batch: DataFrame, batch_id: int) -> None:
        with persisted(batch) as rows:
            if rows.isEmpty():
                return
            usable, unusable = split_complete(rows, SENSOR_FEATURES)
            if train_with is not None and models.latest(rows.sparkSession) is None:
                train_with.see(usable, batch_id)
            model = current_model(usable)
            write(unusable, rejected, batch_id)
            if model is None:
                write_batch(usable, waiting, batch_id)
            else:
                # A replayed batch may have waited before: it is scored below.
                remove(rows.sparkSession, f"{waiting}/batch_id={batch_id}")
                score_waiting(model, usable)
                write(score_sensors(model, usable, keep), out, batch_id)

    return handle
