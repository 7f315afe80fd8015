"""Starting, draining and stopping streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener


def named_writer(stream: DataFrame, name: str, checkpoint_root: str) -> DataStreamWriter:
    """Append-mode writer with a name and a checkpoint of its own.

    Without both, a restarted query would begin a new checkpoint and skip what
    arrived in between.
    """
    return (
        stream.writeStream.queryName(name)
        .outputMode("append")
        .option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/{name}")
    )


def start(writer: DataStreamWriter, every: str | None = None) -> StreamingQuery:
    """Continuous run: a trigger per `every`, or as fast as batches finish."""
    return (writer.trigger(processingTime=every) if every else writer).start()


def drain(writer: DataStreamWriter, timeout: int | None = None) -> StreamingQuery:
    """Process all that is available, then return. Query failures are raised."""
    query = writer.trigger(availableNow=True).start()
    try:
        if query.awaitTermination(timeout) is False:
            raise TimeoutError(f"stream {query.name} still busy after {timeout} s")
    finally:
        if query.isActive:
            query.stop()
    return query


def wait_until_stopped(query: StreamingQuery) -> None:
    """Block until the query ends; Ctrl+C stops it cleanly."""
    try:
        query.awaitTermination()
    except KeyboardInterrupt:
        query.stop()


def recent_records_per_batch(query: StreamingQuery) -> dict[int, int]:
    """Input rows of the recent batches, from Spark's own progress reports: no extra job.

    Spark keeps about the last hundred (spark.sql.streaming.numRecentProgressUpdates); counting_handler
    counts every batch of a long run.

    A foreachBatch handler that reads its batch several times without persisting
    it is reported with a multiple.
    """
    return {p["batchId"]: p["numInputRows"] for p in query.recentProgress}


RECORDS = "records"


def counted(stream: DataFrame, name: str = RECORDS) -> DataFrame:
    """The stream, whose records are counted while they flow: no job and no read of their own."""
    return stream.observe(name, F.count(F.lit(1)).alias("n_records"))


def observed_records(query: StreamingQuery, name: str = RECORDS) -> dict[int, int]:
    """Records of the recent batches of a `counted` stream; an empty batch has none."""
    found = {}
    for progress in query.recentProgress:
        metrics = progress.get("observedMetrics", {}).get(name)
        if metrics is not None:
            found[progress["batchId"]] = metrics["n_records"]
    return found


class RecordListener(StreamingQueryListener):
    """Counts of every batch of the `counted` streams of a session, by query name, for as long as it listens.

    A batch that is reported again after a restart replaces its earlier count.
    """

    def __init__(self, name: str = RECORDS):
        self._name = name
        self.batches: dict[tuple[str | None, int], int] = {}

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self._name)
        if row is not None:
            self.batches[(event.progress.name, event.progress.batchId)] = row["n_records"]
