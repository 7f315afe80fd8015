from __future__ import annotations

import pytest
from clinical import rows
from pyspark.sql import functions as F

from pulseframe.operators import model
from pulseframe.operators.quality import split_complete
from pulseframe.plans.monitoring import monitor, scored_stream
from pulseframe.schemas import SENSOR_FEATURES
from pulseframe.sinks.files import write_batch
from pulseframe.sources.messages import kafka_options, read_messages
from pulseframe.streaming.models import ModelStore
from pulseframe.streaming.parse import parse_messages
from pulseframe.streaming.runs import drain, named_writer, recent_records_per_batch, start
from pulseframe.streaming.scoring import (
    WAITED,
    StreamTraining,
    counting_handler,
    report_handler,
    scoring_handler,
)

FEW = model.ForestSettings(num_trees=3, max_depth=2)
TRAIN = StreamTraining(FEW, least_rows=1)

MESSAGES = [
    ('{"PTT":0.2,"PIR":0.1,"HR":70,"SBP":1,"DBP":2,"x":1}', (0.2, 0.1, 70.0, 1.0, 2.0)),
    ("bad", (None,) * 5),
    ('{"PTT":"abc","PIR":1.5}', (None, 1.5, None, None, None)),
    ('{"ptt":1}', (None,) * 5),
    ('{"PTT":"0.5"}', (None,) * 5),
    (None, (None,) * 5),
]


def _json(n):
    return (
        f'{{"PTT": {n % 10 / 10}, "PIR": {n % 7}, "HR": {50 + n % 50},'
        f' "SBP": {100 + n % 10}, "DBP": {60 + n % 7}}}'
    )


def _write(spark, folder, values, first=0):
    data = [(first + i, v.encode() if v is not None else None) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "event_id long, value binary")
    df.coalesce(1).write.mode("append").parquet(folder)


def _stream(spark, folder):
    return spark.readStream.schema("event_id long, value binary").parquet(folder)


def test_fixture_messages(spark):
    df = spark.createDataFrame(
        [(i, m and m.encode()) for i, (m, _) in enumerate(MESSAGES)], "n int, value binary"
    )
    parsed = rows(parse_messages(df, ["n"]), "n")
    for (n, *fields), (_, expected) in zip(parsed, MESSAGES, strict=True):
        assert fields == [pytest.approx(v) if v is not None else None for v in expected], n


def test_text_messages_and_schema(spark):
    df = spark.createDataFrame([(MESSAGES[0][0],)], "value string")
    parsed = parse_messages(df)
    assert parsed.dtypes == [(c, "float") for c in ("PTT", "PIR", "HR", "SBP", "DBP")]


def test_split_complete_covers_every_row(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0), (None, 1.0), (float("nan"), None), (2.0, None)], "a double, b double"
    )
    usable, rest = split_complete(df, ["a", "b"])
    assert usable.count() == 1
    assert sorted(r.missing for r in rest.collect()) == [["a"], ["a", "b"], ["b"]]


def test_one_parse_per_message(spark):
    df = spark.createDataFrame([(b"{}",)], "value binary")
    usable, _ = split_complete(parse_messages(df), SENSOR_FEATURES)
    plan = usable._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_stream_equals_batch(spark, tmp_path):
    folder = str(tmp_path / "in")
    _write(spark, folder, [_json(n) for n in range(50)] + [m for m, _ in MESSAGES])
    _write(spark, folder, [_json(n) for n in range(30)], first=100)
    parsed = parse_messages(_stream(spark, folder), ["event_id"])
    writer = named_writer(parsed, "equal", str(tmp_path / "cp"))
    drain(writer.format("parquet").option("path", str(tmp_path / "out")))
    batch = parse_messages(spark.read.parquet(folder), ["event_id"])
    assert rows(spark.read.parquet(str(tmp_path / "out")), "event_id") == rows(batch, "event_id")


def test_named_query_resumes(spark, tmp_path):
    folder, counts = str(tmp_path / "in"), str(tmp_path / "counts")
    _write(spark, folder, [_json(1)] * 4)

    def run():
        stream = _stream(spark, folder)
        writer = named_writer(stream, "resumes", str(tmp_path / "cp"))
        return drain(writer.foreachBatch(counting_handler(counts)))

    assert sum(recent_records_per_batch(run()).values()) == 4
    run()
    assert rows(spark.read.parquet(counts).select("batch_id", "n_records")) == [(0, 4)]
    _write(spark, folder, [_json(2)] * 3)
    run()
    assert rows(spark.read.parquet(counts).select("batch_id", "n_records")) == [(0, 4), (1, 3)]


def test_replayed_batch_adds_nothing(spark, tmp_path):
    batch = spark.createDataFrame([(i, _json(i).encode()) for i in range(40)], "event_id long, value binary")
    parsed = parse_messages(batch, ["event_id"])
    out, rejected = str(tmp_path / "out"), str(tmp_path / "rejected")
    handle = scoring_handler(out, rejected, ModelStore(str(tmp_path / "m")), ["event_id"], TRAIN)
    handle(parsed, 0)
    once = rows(spark.read.parquet(out))
    handle(parsed, 0)
    assert rows(spark.read.parquet(out)) == once
    handle(parsed, 1)
    assert spark.read.parquet(out).count() == 80
    handle(parsed.where("event_id < 0"), 2)
    assert spark.read.parquet(out).select("batch_id").distinct().count() == 2


def test_model_is_trained_once_and_reused(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "job")
    store = ModelStore(str(tmp_path / "model"))
    _write(spark, folder, [_json(n) for n in range(60)] + ["bad"])

    def run():
        drain(monitor(_stream(spark, folder), "monitor", root, store, ["event_id"], TRAIN))
        return spark.read.parquet(f"{root}/scored"), spark.read.parquet(f"{root}/rejected")

    scored, rejected = run()
    assert (scored.count(), rejected.count()) == (60, 1)
    uid = store.find(spark).uid
    _write(spark, folder, [_json(n) for n in range(20)], first=100)
    scored, rejected = run()
    assert (scored.count(), rejected.count()) == (80, 1)
    assert store.find(spark).uid == uid
    pairs = scored.groupBy(*SENSOR_FEATURES).agg(F.count_distinct("Predicted_SBP").alias("n"))
    assert pairs.where("n > 1").isEmpty()


def test_readings_before_any_model_are_kept(spark, tmp_path):
    unlabelled = '{"PTT": 0.1, "PIR": 1, "HR": 60}'
    batch = spark.createDataFrame([(1, unlabelled), (2, "bad")], "event_id long, value string")
    out, rejected = str(tmp_path / "out"), str(tmp_path / "rejected")
    store = ModelStore(str(tmp_path / "m"))
    handle = scoring_handler(out, rejected, store, ["event_id"], TRAIN)
    handle(parse_messages(batch, ["event_id"]), 0)
    kept = spark.read.parquet(rejected).select("event_id", "missing")
    assert rows(kept, "event_id") == [(2, ["PTT", "PIR", "HR"])]
    assert rows(spark.read.parquet(f"{rejected}-waiting").select("event_id")) == [(1,)]
    assert store.find(spark) is None
    labelled = parse_messages(spark.createDataFrame([(9, _json(3))], "event_id long, value string"), ["event_id"])
    for _ in range(2):
        handle(labelled, 1)
        assert rows(spark.read.parquet(out).select("event_id", "batch_id"), "event_id") == [(1, WAITED), (9, 1)]
    again = scoring_handler(out, rejected, store, ["event_id"], TRAIN)
    again(labelled, 1)
    assert rows(spark.read.parquet(out).select("event_id", "batch_id"), "event_id") == [(1, WAITED), (9, 1)]


def test_training_waits_for_enough_rows_and_is_bounded(spark):
    batch = parse_messages(spark.createDataFrame([(_json(n),) for n in range(60)], "value string"))
    assert StreamTraining(FEW, least_rows=61).model_from(batch) is None
    assert StreamTraining(FEW, least_rows=60, most_rows=20).model_from(batch) is not None


def test_newer_version_is_picked_up(spark, tmp_path):
    batch = parse_messages(spark.createDataFrame([(n, _json(n)) for n in range(30)], "event_id long, value string"), ["event_id"])
    store, out = ModelStore(str(tmp_path / "m")), str(tmp_path / "out")
    handle = scoring_handler(out, str(tmp_path / "rejected"), store, ["event_id"], TRAIN)
    handle(batch, 0)
    flat = model.ForestSettings(num_trees=1, max_depth=0, bootstrap=False)
    store.publish(spark, model.fit(model.sensor_pipeline(flat), batch.drop("event_id"), flat))
    handle(batch, 1)
    kinds = spark.read.parquet(out).groupBy("batch_id").agg(F.count_distinct("Predicted_SBP").alias("n"))
    found = {r.batch_id: r.n for r in kinds.collect()}
    assert found[1] == 1 < found[0]


def test_half_written_model_is_not_used(spark, tmp_path):
    store = ModelStore(str(tmp_path / "m"))
    assert store.find(spark) is None
    readings = parse_messages(
        spark.createDataFrame([(_json(n),) for n in range(30)], "value string")
    )
    trained = model.sensor_pipeline(FEW).fit(readings)
    model.save_model(trained, str(tmp_path / "m" / "model-1-unfinished"))
    assert store.find(spark) is None
    store.publish(spark, trained)
    assert store.find(spark).uid == trained.uid


def test_inline_scoring_on_a_stream(spark, tmp_path):
    folder = str(tmp_path / "in")
    _write(spark, folder, [_json(n) for n in range(40)] + ["bad", '{"PTT": 1}'])
    batch = spark.read.parquet(folder)
    usable, _ = split_complete(parse_messages(batch, ["event_id"]), SENSOR_FEATURES)
    trained = model.sensor_pipeline(FEW).fit(usable)
    scored, rejected = scored_stream(_stream(spark, folder), trained, ["event_id"])
    assert scored.isStreaming and rejected.isStreaming
    for name, stream in (("scored", scored), ("rejected", rejected)):
        writer = named_writer(stream, name, str(tmp_path / "cp"))
        drain(writer.format("parquet").option("path", str(tmp_path / name)))
    expected = rows(model.score_sensors(trained, usable, ["event_id"]), "event_id")
    assert rows(spark.read.parquet(str(tmp_path / "scored")), "event_id") == expected
    assert spark.read.parquet(str(tmp_path / "rejected")).count() == 2


def test_batch_reports(spark, tmp_path):
    folder, seen = str(tmp_path / "in"), []
    _write(spark, folder, [_json(n) for n in range(9)])
    handler = report_handler(lambda *report: seen.append(report), sample=4)
    writer = named_writer(_stream(spark, folder), "reports", str(tmp_path / "cp"))
    drain(writer.foreachBatch(handler))
    [(batch_id, n_records, sample)] = seen
    assert (batch_id, n_records, len(sample)) == (0, 9, 4)
    handler(spark.read.parquet(folder).where("event_id < 0"), 1)
    assert len(seen) == 1


def test_failures_reach_the_caller(spark, tmp_path):
    folder = str(tmp_path / "in")
    _write(spark, folder, [_json(1)])

    def broken(batch, batch_id):
        raise RuntimeError("no disk")

    writer = named_writer(_stream(spark, folder), "broken", str(tmp_path / "cp"))
    with pytest.raises(Exception, match="no disk"):
        drain(writer.foreachBatch(broken))


def test_continuous_run_and_stop(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    _write(spark, folder, [_json(1)] * 5)
    writer = named_writer(_stream(spark, folder), "continuous", str(tmp_path / "cp"))
    query = start(writer.foreachBatch(lambda b, i: write_batch(b, out, i)), every="1 second")
    query.processAllAvailable()
    assert query.name == "continuous"
    query.stop()
    assert not query.isActive
    assert spark.read.parquet(out).count() == 5


def test_message_source(spark, tmp_path):
    options = kafka_options("a:1,b:2", "vitals", max_offsets_per_trigger=1000, min_partitions=64)
    assert options == {
        "kafka.bootstrap.servers": "a:1,b:2",
        "subscribe": "vitals",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "1000",
        "minPartitions": "64",
    }
    rate = read_messages(spark, {"rowsPerSecond": "1"}, source="rate")
    assert rate.isStreaming and "value" in rate.columns
