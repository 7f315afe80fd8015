"""Committed batches: a batch is there once and whole, whenever its writer dies."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pulseframe.operators.model import ForestSettings, fit, sensor_pipeline
from pulseframe.sinks import files
from pulseframe.sinks.manifest import Manifest
from pulseframe.streaming.models import ModelStore
from pulseframe.streaming.sampling import SampledTraining, StreamSample
from pulseframe.streaming.scoring import WAITED, StreamTraining, scoring_handler

CONSTANT = ForestSettings(num_trees=1, max_depth=0, bootstrap=False)


def batch(spark, first, n, labelled=True):
    rows = [(i, float(i), 1.0, 60.0, float(i % 60 + 90) if labelled else None, 80.0 if labelled else None) for i in range(first, first + n)]
    return spark.createDataFrame(rows, "event_id long, PTT float, PIR float, HR float, SBP float, DBP float")


def ids(df):
    return sorted(r["event_id"] for r in df.select("event_id").collect())


def test_a_killed_writer_leaves_nothing_to_see(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    files.commit_batch(batch(spark, 0, 3), path, 0)

    def dies(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as broken:
        broken.setattr(Manifest, "add", dies)
        with pytest.raises(RuntimeError):
            files.commit_batch(batch(spark, 3, 2), path, 1)
    assert ids(files.read_committed(spark, path, "event_id long")) == [0, 1, 2]
    for _ in range(2):
        files.commit_batch(batch(spark, 3, 2), path, 1)
        assert ids(files.read_committed(spark, path, "event_id long")) == [0, 1, 2, 3, 4]


def test_of_two_writers_one_counts(spark, tmp_path):
    path = str(tmp_path / "out")
    files.commit_batch(batch(spark, 0, 3), path, 0)
    batch(spark, 0, 3).write.parquet(f"{path}/data/batch-0-0")
    Manifest(f"{path}/commits", files.COMMITS).add(spark, [(0, "batch-0-0")])
    found = files.read_committed(spark, path, "event_id long")
    assert ids(found) == [0, 1, 2] and {r["batch_id"] for r in found.collect()} == {0}


def test_compacted_lists_say_the_same(spark, tmp_path):
    path = str(tmp_path / "out")
    assert files.read_committed(spark, path, "event_id long").count() == 0
    for number in (-1, 0, 1, 2):
        files.commit_batch(batch(spark, 10 * number, 2), path, number)
    before = sorted(map(tuple, files.read_committed(spark, path, "event_id long").collect()))
    files.compact_commits(spark, path)
    assert sorted(map(tuple, files.read_committed(spark, path, "event_id long").collect())) == before
    assert len(Manifest(f"{path}/commits", files.COMMITS).entries(spark).inputFiles()) == 1


def test_waiting_rows_are_scored_once(spark, tmp_path):
    """A restart with a newer model leaves the scores of rows that had waited as they are."""
    out, rejected, store = str(tmp_path / "out"), str(tmp_path / "rejected"), ModelStore(str(tmp_path / "model"))
    handler = lambda: scoring_handler(out, rejected, store, ["event_id"], StreamTraining(CONSTANT, least_rows=5))
    handler()(batch(spark, 0, 4, labelled=False), 0)
    handler()(batch(spark, 100, 8), 1)
    scored = files.read_batches(spark, out, "event_id long, Predicted_SBP double")
    before = {r["event_id"]: r["Predicted_SBP"] for r in scored.where(F.col("batch_id") == WAITED).collect()}
    assert set(before) == {0, 1, 2, 3}
    newer = fit(sensor_pipeline(CONSTANT), batch(spark, 30, 20).drop("event_id"), CONSTANT)
    store.publish(spark, newer)
    handler()(batch(spark, 200, 3), 2)
    again = {r["event_id"]: r["Predicted_SBP"] for r in files.read_batches(spark, out, "event_id long, Predicted_SBP double").collect()}
    assert {i: again[i] for i in before} == before and again[200] != before[0]


def test_a_model_from_several_batches(spark, tmp_path):
    sample = StreamSample(str(tmp_path / "sample"), 30, ["PTT", "SBP"])
    training = SampledTraining(CONSTANT, least_rows=12, sample=sample)
    store = ModelStore(str(tmp_path / "model"))
    handler = scoring_handler(str(tmp_path / "out"), str(tmp_path / "rejected"), store, ["event_id"], training, write=files.commit_batch)
    for number in range(3):
        handler(batch(spark, 5 * number, 5), number)
        assert (store.latest(spark) is None) == (number < 2)
    scored = files.read_committed(spark, str(tmp_path / "out"), "event_id long, Predicted_SBP double").collect()
    assert sorted(r["event_id"] for r in scored) == list(range(15))
    assert {r["Predicted_SBP"] for r in scored} == {sum(i + 90 for i in range(15)) / 15}


@pytest.mark.parametrize("cut", [[40], [1, 39], [13, 13, 14]])
def test_samples_do_not_depend_on_the_batches(spark, tmp_path, cut):
    sample, first = StreamSample(str(tmp_path / "sample"), 9, ["event_id"]), 0
    for number, n in enumerate(cut):
        for _ in range(2):
            sample.add(batch(spark, first, n).select("event_id"), number)
        first += n
    import hashlib

    expected = sorted(range(40), key=lambda i: int(hashlib.md5(f"42|{i}".encode()).hexdigest()[:15], 16))[:9]
    assert ids(sample.read(spark, "event_id long")) == sorted(expected)
    assert sample.count(spark) == 9
