"""Named queries over the test tables; each takes (spark, folder).

Times leave as dates and derived doubles as 6 decimals, so that another SQL
engine can reproduce the values.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.functions import age_in_years
from pulseframe.operators import extract, metrics, model, quality, split, trees, vitals
from pulseframe.operators.codes import all_codes, code_dimension, code_lists
from pulseframe.plans import analogs, monitoring
from pulseframe.plans.batch import run_batch
from pulseframe.plans.incremental import FeatureStore
from pulseframe.schemas import (
    BATCH_FEATURES,
    BATCH_LABEL,
    CLINICAL_SCHEMAS,
    ITEM_CODE_TEXT,
    OBSERVATION_KEY,
    SENSOR_FEATURES,
    SENSOR_MESSAGE,
    SENSOR_TARGETS,
    VITAL_COLUMNS,
)
from pulseframe.sinks.files import commit_batch, preview, read_batches, read_committed, write_csv, write_predictions
from pulseframe.sources import bucketed
from pulseframe.sources.jdbc import cut_slices, modulus_slices, quantile_cuts, range_slices, slice_number
from pulseframe.sources.tables import read_table, stream_table
from pulseframe.staging import persisted, stage, work_dir
from pulseframe.streaming.models import ModelStore
from pulseframe.streaming.parse import explain_messages, parse_messages, split_by_reasons
from pulseframe.streaming.runs import counted, drain, named_writer, observed_records
from pulseframe.streaming.sampling import StreamSample
from pulseframe.streaming.scoring import WAITED, StreamTraining, counting_handler, scoring_handler

GROUPS = code_lists()
CODES = all_codes(GROUPS)


def _plain(df: DataFrame) -> DataFrame:
    """Timestamps as dates, doubles and floats as doubles with 6 decimals."""
    shown = []
    for field in df.schema.fields:
        column = F.col(field.name)
        kind = field.dataType.typeName()
        if kind == "timestamp":
            column = column.cast("date")
        elif kind in ("double", "float"):
            column = F.round(column.cast("double"), 6)
        shown.append(column.alias(field.name))
    return df.select(shown)


def _dated(df: DataFrame) -> DataFrame:
    """Timestamps as dates; values as they were read."""
    times = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({name: F.col(name).cast("date") for name in times})


# Relational extract.


def item_groups(spark, base):
    """Readings per listed code."""
    readings = analogs.order_history(spark, base).chartevents
    return (
        readings.join(F.broadcast(code_dimension(spark, ITEM_CODE_TEXT)), "itemid")
        .groupBy("measurement", "itemid")
        .agg(F.count(F.lit(1)).alias("n_readings"))
    )


def chart_extract(spark, base):
    return _dated(extract.join_clinical_tables(analogs.order_history(spark, base)))


def extract_filtered(spark, base):
    return _dated(extract.clinical_extract(analogs.order_history(spark, base), CODES))


def extract_topn_most(spark, base):
    """A limit near the size of the table."""
    return _dated(extract.clinical_extract(analogs.order_history(spark, base), CODES, limit=30_000))


def extract_topn(spark, base):
    return _dated(extract.clinical_extract(analogs.order_history(spark, base), CODES, limit=1000))


# Vitals.


def classify_measurement(spark, base):
    readings = analogs.order_history(spark, base).chartevents
    return _dated(
        vitals.classify(readings, GROUPS).select(
            "hadm_id", "charttime", "itemid", "valuenum", "measurement"
        )
    )


def classify_by_dimension(spark, base):
    """Readings and known values per vital sign, Other included."""
    tagged = vitals.classify_by_dimension(
        analogs.order_history(spark, base).chartevents, code_dimension(spark)
    )
    return _plain(
        tagged.groupBy("measurement").agg(
            F.count(F.lit(1)).alias("n_readings"),
            F.count("valuenum").alias("n_values"),
            F.sum("valuenum").alias("total"),
        )
    )


def _classified(tables):
    return vitals.classify(extract.valid_readings(tables.chartevents, CODES), GROUPS)


def vitals_pivot(spark, base):
    return _plain(vitals.pivot_vitals(_classified(analogs.order_history(spark, base))))


def weekly_vitals(spark, base):
    return _plain(vitals.pivot_vitals(_classified(analogs.event_log(spark, base))))


def demographics(spark, base):
    return _plain(vitals.demographics(extract.stays(analogs.order_history(spark, base))))


def age_at_admission(spark, base):
    stays = extract.stays(analogs.order_history(spark, base))
    return _plain(
        stays.select(
            "hadm_id",
            F.to_date("admittime").alias("admitted"),
            F.to_date("dob").alias("born"),
            F.datediff(F.to_date("admittime"), F.to_date("dob")).cast("bigint").alias("days"),
            age_in_years(F.col("dob"), F.col("admittime")).alias("age"),
        )
    )


def vitals_with_demographics(spark, base):
    tables = analogs.order_history(spark, base)
    classified = _classified(tables)
    return _plain(
        vitals.join_demographics(vitals.pivot_vitals(classified), tables)
    )


def complete_vitals(spark, base):
    wide = vitals.pivot_vitals(_classified(analogs.order_history(spark, base)))
    return _plain(vitals.complete_vitals(wide))


def feature_table(spark, base):
    return _plain(vitals.feature_table(analogs.order_history(spark, base)))


def bucketed_features(spark, base):
    """The feature table from readings that lie in buckets by admission."""
    return _plain(bucketed.bucketed_features(bucketed.land_bucketed(analogs.order_history(spark, base), buckets=8)))


def bucketed_skewed_features(spark, base):
    """The same of readings a third of which belong to one admission, from a folder opened again."""
    landed = bucketed.land_bucketed(analogs.skewed_order_history(spark, base), buckets=8)
    return _plain(bucketed.bucketed_features(bucketed.open_bucketed(spark, landed.root)))


def single_demographics(spark, base):
    """Features where every fifth patient has two rows, of which one counts."""
    return _plain(vitals.feature_table(analogs.repeated_patients(spark, base), repeated="first"))


def incremental_features(spark, base):
    """Weekly features kept by three updates: a first part of the events, the rest, and nothing new."""
    tables = analogs.event_log(spark, base, numbered=True)
    store = FeatureStore(work_dir(spark, "feature-store"), "event_id", partitions=16)
    middle = tables.chartevents.agg(F.floor(F.avg("event_id"))).first()[0]
    early = replace(tables, chartevents=tables.chartevents.where(F.col("event_id") <= middle))
    for part in (early, tables, tables):
        store.update(part)
    return _plain(store.read(spark))


def features_from_extract(spark, base):
    """The same table from the joined extract, written once and read twice."""
    rows = extract.clinical_extract(analogs.order_history(spark, base), CODES)
    staged = stage(rows.select(extract.FEATURE_COLUMNS), "extract")
    return _plain(vitals.preprocess_extract(staged, GROUPS))


def weekly_features(spark, base):
    return _plain(vitals.feature_table(analogs.event_log(spark, base)))


def skewed_extract(spark, base):
    """A third of the readings in one admission, joined without broadcasting a table."""
    tables = analogs.skewed_order_history(spark, base)
    return _dated(extract.clinical_extract(tables, CODES, broadcast_bytes=0))


def skewed_features(spark, base):
    """The feature table of the same readings, in the form for large tables."""
    tables = analogs.skewed_order_history(spark, base)
    return _plain(vitals.feature_table(tables, broadcast_bytes=0))


def late_skew_features(spark, base):
    """An admission that is rare among the readings and frequent among the complete observations."""
    tables = analogs.late_skewed_order_history(spark, base)
    return _plain(vitals.feature_table(tables, broadcast_bytes=0))


def repeated_dictionary(spark, base):
    """A code listed twice counts its readings twice, in both forms of the feature table."""
    tables = analogs.repeated_dictionary(spark, base)
    rows = extract.clinical_extract(tables, CODES).select(extract.FEATURE_COLUMNS)
    joined = vitals.preprocess_extract(stage(rows, "extract"), GROUPS)
    direct = vitals.feature_table(tables)
    form = F.lit("direct").alias("form")
    return _plain(direct.select(form, "*").union(joined.select(F.lit("joined"), *direct.columns)))


def persisted_features(spark, base):
    """The feature table kept for two consumers, a check and a copy, and released."""
    with persisted(vitals.feature_table(analogs.order_history(spark, base))) as features:
        quality.validate(features, OBSERVATION_KEY, "features")
        copy = stage(features, "features")
    return _plain(copy)


def feature_sample(spark, base):
    """Ten observations for display, the first in chart order."""
    return preview(_plain(extract.in_chart_order(_weekly(spark, base), OBSERVATION_KEY)), 10)


# Quality.


def step_counts(spark, base):
    return quality.step_counts(_classified(analogs.order_history(spark, base)))


def observed_steps(spark, base):
    """The same counts, taken while the complete observations are written."""
    features, seen = quality.observed_steps(_classified(analogs.order_history(spark, base)))
    stage(features, "features")
    counts = quality.steps_seen(seen)
    names = ["n_readings", "n_observations", "n_complete"]
    return spark.createDataFrame([tuple(counts[n] for n in names)], ", ".join(f"{n} long" for n in names))


def quality_report(spark, base):
    """Summaries of the four clinical tables, checked for their columns."""
    tables = analogs.order_history(spark, base)
    parts = []
    for name, schema in CLINICAL_SCHEMAS.items():
        table = getattr(tables, name)
        quality.require_columns(table, schema.names, name)
        parts.append(quality.summary(table, name))
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


def validated_counts(spark, base):
    """Row counts of the four clinical tables, each checked for columns and rows."""
    tables = analogs.order_history(spark, base)
    counts = [
        (name, quality.validate(getattr(tables, name), schema.names, name))
        for name, schema in CLINICAL_SCHEMAS.items()
    ]
    return spark.createDataFrame(counts, "name string, n_rows long")


def repeated_admissions(spark, base):
    """Patients with more than one admission: keys that do not identify a row."""
    return quality.repeated_keys(analogs.order_history(spark, base).admissions, "subject_id")


# Splits, metrics and models.


def _weekly(spark, base):
    """Weekly observations; charttime is a plain date, the split key of any engine."""
    features = vitals.feature_table(analogs.event_log(spark, base))
    return features.withColumn("charttime", F.col("charttime").cast("date"))


def hash_split_counts(spark, base):
    features = _weekly(spark, base)
    part = F.when(split.in_training_part(features, OBSERVATION_KEY), "train").otherwise("test")
    return features.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n_rows"))


def grouped_split(spark, base):
    """Rows and patients of both parts of a split by patient, and patients that are in both."""
    tables = analogs.order_history(spark, base)
    rows = stage(tables.admissions.select("subject_id", "hadm_id"), "stays")
    train, test = split.grouped_split(rows, "subject_id")
    parts = train.select("subject_id", F.lit("train").alias("part")).union(test.select("subject_id", F.lit("test")))
    both = (F.min("part") != F.max("part")).alias("both")
    sides = parts.groupBy("subject_id").agg(F.min("part").alias("part"), F.count(F.lit(1)).alias("n"), both)
    return sides.groupBy("part").agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_patients"), F.count_if("both").alias("n_in_both")
    )


def random_split_cover(spark, base):
    """Rows of both random parts together, and how many observations those are."""
    train, test = split.random_split(stage(_weekly(spark, base), "features"))
    return train.union(test).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(*OBSERVATION_KEY).alias("n_observations")
    )


def mean_baseline_metrics(spark, base):
    train, test = split.key_split(stage(_weekly(spark, base), "features"), OBSERVATION_KEY)
    scored = metrics.score_with_mean(train, test, BATCH_LABEL)
    return _plain(metrics.regression_metrics(scored, BATCH_LABEL))


def category_index(spark, base):
    features = stage(_weekly(spark, base), "features")
    indexed = model.category_indexer().fit(features).transform(features)
    return indexed.groupBy("gender", "gender_index").agg(F.count(F.lit(1)).alias("n_rows"))


def _unpacked(df: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    cells = vector_to_array("features")
    return df.select(*keys, *[cells[i].alias(name) for i, name in enumerate(names)])


def assembled_features(spark, base):
    """Vector components by observation; observations without an age are skipped."""
    features = stage(_weekly(spark, base), "features")
    indexed = model.category_indexer().fit(features).transform(features)
    vectors = model.assembler(BATCH_FEATURES, handle_invalid="skip").transform(indexed)
    return _plain(_unpacked(vectors, OBSERVATION_KEY, BATCH_FEATURES))


def _forest(spark, base):
    features = stage(_weekly(spark, base), "features")
    return model.train_and_evaluate(features, handle_invalid="skip")


def rf_metrics(spark, base):
    return _forest(spark, base).metrics


def rf_predictions(spark, base):
    return _forest(spark, base).predictions.select(*OBSERVATION_KEY, BATCH_LABEL, "prediction")


def rf_feature_importance(spark, base):
    return model.feature_importances(spark, _forest(spark, base).model)


def rf_coverage(spark, base):
    """Held-out rows scored, and how many predictions lie within the label's range.

    A forest averages training labels, so all must.
    """
    features = stage(_weekly(spark, base), "features")
    scored = model.train_and_evaluate(features, handle_invalid="skip").predictions
    lowest = features.agg(F.min(BATCH_LABEL)).scalar()
    highest = features.agg(F.max(BATCH_LABEL)).scalar()
    return scored.agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.count_if(F.col("prediction").between(lowest, highest)).alias("n_in_range"),
    )


CONSTANT = model.ForestSettings(num_trees=1, max_depth=0, bootstrap=False)
# More bins than the feature has values: the split is the exact best one.
STUMP = model.ForestSettings(num_trees=1, max_depth=1, bootstrap=False, feature_subset="all", max_bins=256)


def _constant(spark, base):
    features = stage(_weekly(spark, base), "features")
    return model.train_and_evaluate(features, CONSTANT, handle_invalid="skip")


def rf_constant(spark, base):
    """A forest of depth 0 predicts the training mean."""
    scored = _constant(spark, base).predictions
    return _plain(scored.select(*OBSERVATION_KEY, BATCH_LABEL, "prediction"))


def rf_constant_metrics(spark, base):
    return _plain(_constant(spark, base).metrics)


def _stump(spark, base):
    """Depth 1 on one feature with few values: the split that leaves the least variance."""
    return model.train_dual_target(
        _labelled(spark, base), STUMP, keys=["event_id"], features=["HR"]
    )


def rf_stump(spark, base):
    return _plain(_stump(spark, base).predictions.select("event_id", "Predicted_SBP"))


def dual_target_stump(spark, base):
    return _plain(
        _stump(spark, base).predictions.select("event_id", "Predicted_SBP", "Predicted_DBP")
    )


def rf_stump_importance(spark, base):
    return model.feature_importances(spark, _stump(spark, base).model, ["HR"])


# As many bins as the features have values, so that the splits are the exact best ones.
DEPTH2 = replace(STUMP, max_depth=2)


def rf_depth2(spark, base):
    """A tree of depth 2 on two features, scored as column expressions."""
    readings = _labelled(spark, base)
    fitted = model.train_dual_target(readings, DEPTH2, keys=["event_id"], features=["HR", "PIR"]).model
    _, test = split.key_split(readings, ["event_id"])
    return _plain(trees.score_by_expressions(fitted, test).select("event_id", "Predicted_SBP", "Predicted_DBP"))


def rf_expression_agreement(spark, base):
    """Messages scored by expressions of 100 trees, and how many get the model's scores to the last bit."""
    settings = replace(model.ForestSettings(), max_depth=2)
    fitted = model.train_dual_target(_labelled(spark, base), settings, keys=["event_id"]).model
    usable, _ = quality.split_complete(_readings(spark, base), SENSOR_FEATURES)
    usable = stage(usable, "usable")
    mine = trees.score_by_expressions(fitted, usable).select(
        "event_id", F.col("Predicted_SBP").alias("sbp"), F.col("Predicted_DBP").alias("dbp")
    )
    both = model.score_sensors(fitted, usable, ["event_id"]).join(mine, "event_id")
    same = (F.col("Predicted_SBP") == F.col("sbp")) & (F.col("Predicted_DBP") == F.col("dbp"))
    return both.agg(F.count(F.lit(1)).alias("n_scored"), F.count_if(same).alias("n_equal"))


FOUR_FEATURES = ["HR", "PIR", "phase", "step"]


def _four_features(spark, base):
    """A stump among four features, and the readings that did not train it."""
    phase, step = F.col("event_id") % 30, F.floor(F.col("PTT") / 16)
    readings = _labelled(spark, base).withColumns({"phase": phase.cast("double"), "step": step.cast("double")})
    train, test = split.key_split(stage(readings, "readings"), ["event_id"])
    pipeline = Pipeline(stages=[model.assembler(FOUR_FEATURES), model.forest("SBP", STUMP)])
    return model.fit(pipeline, train.select("SBP", *FOUR_FEATURES), STUMP), test


def rf_four_importances(spark, base):
    """The importance goes to the feature whose best split explains most."""
    fitted, _ = _four_features(spark, base)
    return model.feature_importances(spark, fitted, FOUR_FEATURES)


def permutation_importance(spark, base):
    """The same stump on held-out readings with one feature's values in other places."""
    fitted, test = _four_features(spark, base)
    return _plain(model.permutation_importances(fitted, test, "SBP", FOUR_FEATURES, ["event_id"]))


def batch_job(spark, base):
    """Rows after each step of the whole job; the predictions are counted in the file."""
    path = work_dir(spark, "batch-job")
    result = run_batch(analogs.event_log(spark, base), path, CONSTANT, handle_invalid="skip")
    written = spark.read.schema("label double, prediction double").csv(path, header=True)
    return result.features.agg(F.count(F.lit(1)).alias("n_features")).join(
        written.agg(F.count(F.lit(1)).alias("n_predictions"), F.count_distinct("prediction").alias("n_values"))
    )


def model_roundtrip(spark, base):
    """Held-out rows on which a saved and reloaded model predicts the same."""
    result = _forest(spark, base)
    path = work_dir(spark, "model")
    model.save_model(result.model, path)
    again = model.load_model(path).transform(
        result.predictions.select(*OBSERVATION_KEY, *VITAL_COLUMNS.values(), "gender", "age",
                                  F.col("prediction").alias("before"))
    )
    return again.agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.count_if(F.col("prediction") == F.col("before")).alias("n_equal"),
    )


# Sensor messages, as a table.


def _readings(spark, base):
    messages = analogs.sensor_messages(read_table(spark, base, "events"))
    return parse_messages(messages, ["event_id"])


def json_parse(spark, base):
    return _plain(_readings(spark, base))


def rejected_messages(spark, base):
    """Messages that cannot be scored, with what they lack."""
    _, unusable = quality.split_complete(_readings(spark, base), SENSOR_FEATURES)
    return unusable.select("event_id", F.array_join("missing", ",").alias("missing"))


def rejected_reasons(spark, base):
    """Faulty messages with what is wrong with which field, and as they came."""
    explained = explain_messages(analogs.faulty_messages(read_table(spark, base, "events")), keep=["event_id"])
    _, rejected = split_by_reasons(explained)
    named = F.array_join(F.transform("reasons", lambda r: F.concat_ws(":", r["field"], r["reason"])), ",")
    return rejected.select("event_id", named.alias("reasons"), F.col("raw").cast("string").alias("raw"))


def sensor_features(spark, base):
    usable, _ = quality.split_complete(_readings(spark, base), SENSOR_FEATURES)
    vectors = model.assembler(SENSOR_FEATURES).transform(usable)
    return _plain(_unpacked(vectors, ["event_id"], SENSOR_FEATURES))


def _labelled(spark, base):
    labelled, _ = quality.split_complete(
        _readings(spark, base), [*SENSOR_FEATURES, *SENSOR_TARGETS]
    )
    return stage(labelled, "readings")


def dual_target_predictions(spark, base):
    result = model.train_dual_target(_labelled(spark, base), keys=["event_id"])
    return result.predictions.select(
        "event_id", *SENSOR_FEATURES, "Predicted_SBP", "Predicted_DBP"
    )


def dual_target_metrics(spark, base):
    return model.train_dual_target(_labelled(spark, base), keys=["event_id"]).metrics


def dual_target_coverage(spark, base):
    """One output row per held-out reading, with both predictions."""
    scored = dual_target_predictions(spark, base)
    return scored.agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.count_distinct("event_id").alias("n_readings"),
        F.count_if(
            F.col("Predicted_SBP").isNotNull() & F.col("Predicted_DBP").isNotNull()
        ).alias("n_with_both"),
    )


# Sources and sinks.


def csv_roundtrip(spark, base):
    features = _weekly(spark, base)
    path = work_dir(spark, "csv")
    write_csv(features, path)
    return _plain(spark.read.schema(features.schema).csv(path, header=True))


def single_file_csv(spark, base):
    """Rows and files of a CSV written through one task."""
    path = work_dir(spark, "csv")
    write_csv(_weekly(spark, base), path, single_file=True)
    back = spark.read.csv(path, header=True).select(F.input_file_name().alias("file"))
    return back.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("file").alias("n_files"))


def predictions_file(spark, base):
    """The predictions file as written, read back."""
    train, test = split.key_split(stage(_weekly(spark, base), "features"), OBSERVATION_KEY)
    scored = metrics.score_with_mean(train, test, BATCH_LABEL)
    path = work_dir(spark, "predictions")
    write_predictions(scored, path)
    back = spark.read.schema("label double, prediction double").csv(path, header=True)
    return _plain(back)


def jdbc_slices(spark, base):
    """Rows of orders that exactly one slice of a parallel read takes, per method."""
    orders = read_table(spark, base, "orders")
    low, high = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    methods = {
        "range": range_slices("o_orderkey", low, high, 8),
        "modulus": modulus_slices(["o_orderkey", "o_custkey"], 8),
    }
    columns = []
    for method, slices in methods.items():
        hits = sum((F.coalesce(F.expr(clause), F.lit(False)).cast("int") for clause in slices), F.lit(0))
        columns.append(F.struct(F.lit(method).alias("method"), hits.alias("hits"),
                                slice_number(slices).alias("slice")))
    return (
        orders.select(F.inline(F.array(*columns)))
        .groupBy("method")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col("hits") == 1).alias("n_taken_once"),
            F.count_distinct("slice").alias("n_slices"),
        )
    )


def quantile_slices(spark, base):
    """Slices of a key that crowds at its low end: rows, rows taken once, and whether no slice is far above the mean."""
    # The cube passes 64 bits beyond keys of 2,097,151; as an exact decimal it holds keys up to 10**12.
    whole = F.col("o_orderkey").cast("decimal(38,0)")
    key = (whole * whole * whole).alias("k")
    orders = stage(read_table(spark, base, "orders").select(key), "orders")
    low, high = (None if v is None else int(v) for v in orders.agg(F.min("k"), F.max("k")).first())
    methods = {"range": range_slices("k", low, high, 8), "quantile": cut_slices("k", quantile_cuts(orders, "k", 8))}
    columns = []
    for method, slices in methods.items():
        hits = sum((F.coalesce(F.expr(clause), F.lit(False)).cast("int") for clause in slices), F.lit(0))
        columns.append(F.struct(F.lit(method).alias("method"), hits.alias("hits"), slice_number(slices).alias("slice")))
    rows = orders.select(F.inline(F.array(*columns))).groupBy("method", "slice")
    rows = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("hits") == 1).alias("once"))
    return rows.groupBy("method").agg(
        F.sum("n").alias("n_rows"), F.sum("once").alias("n_taken_once"), (F.max("n") * 8 <= F.sum("n") * 1.5).alias("even")
    )


# Streams.


def _query_name(root: str) -> str:
    """Each call has a folder of its own, so its query may have a name of its own."""
    return root.rsplit("/", 1)[-1]


def _message_stream(spark, base):
    return analogs.sensor_messages(stream_table(spark, base, "events"))


def stream_parse(spark, base):
    root = work_dir(spark, "stream-parse")
    parsed = parse_messages(_message_stream(spark, base), ["event_id"])
    drain(
        named_writer(parsed, _query_name(root), f"{root}/checkpoints")
        .format("parquet")
        .option("path", f"{root}/readings")
    )
    return _plain(spark.read.schema(parsed.schema).parquet(f"{root}/readings"))


def _counted_stream(spark, base, runs):
    """Records per event type, counted micro-batch by micro-batch."""
    root = work_dir(spark, "stream-counts")
    handler = counting_handler(f"{root}/counts", by=["event_type"])
    for _ in range(runs):
        events = stream_table(spark, base, "events").select("event_type")
        drain(named_writer(events, _query_name(root), f"{root}/checkpoints").foreachBatch(handler))
    counts = read_batches(spark, f"{root}/counts", "event_type string, n_records long")
    return counts.groupBy("event_type").agg(F.sum("n_records").alias("n_records"))


def stream_batch_counts(spark, base):
    return _counted_stream(spark, base, runs=1)


def stream_observed_counts(spark, base):
    """All records of the stream, counted while its batches are written."""
    root = work_dir(spark, "stream-observed")
    events = counted(stream_table(spark, base, "events").select("event_id"))
    writer = named_writer(events, _query_name(root), f"{root}/checkpoints").format("parquet").option("path", f"{root}/events")
    return spark.createDataFrame([(sum(observed_records(drain(writer)).values()),)], "n_records long")


def stream_sample(spark, base):
    """A sample of 200 labelled readings over a stream of five batches, each of them delivered twice."""
    root = work_dir(spark, "stream-sample")
    labelled = _labelled(spark, base).select("event_id")
    for part in range(5):
        labelled.where(F.col("event_id") % 5 == part).coalesce(1).write.parquet(f"{root}/in/{part}")
    stream = spark.readStream.schema(labelled.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/*")
    sample = StreamSample(f"{root}/sample", 200, ["event_id"])

    def twice(batch, batch_id):
        sample.add(batch, batch_id)
        sample.add(batch, batch_id)

    drain(named_writer(stream, _query_name(root), f"{root}/checkpoints").foreachBatch(twice))
    return sample.read(spark, "event_id long")


def stream_resumed(spark, base):
    """The same after a restart from the checkpoint: no record lost or counted again."""
    return _counted_stream(spark, base, runs=2)


def _monitored(spark, base, train_with=StreamTraining(), streams=(_message_stream,)):
    """Both outputs after `streams` have run one after another."""
    root = work_dir(spark, "stream-scored")
    for n, messages in enumerate(streams):
        drain(
            monitoring.monitor(
                messages(spark, base),
                f"{_query_name(root)}-{n}",
                root,
                ModelStore(f"{root}/model"),
                keep=["event_id"],
                train_with=train_with,
            )
        )
    scored = read_batches(
        spark,
        f"{root}/scored",
        "event_id long, PTT float, PIR float, HR float, Predicted_SBP double, Predicted_DBP double",
    )
    fields = ", ".join(f"{field.name} float" for field in SENSOR_MESSAGE.fields)
    rejected = read_batches(
        spark, f"{root}/rejected", f"event_id long, {fields}, missing array<string>"
    )
    return scored, rejected


def stream_scored(spark, base):
    """Trained on the first batch, then scored; one row per usable message."""
    scored, _ = _monitored(spark, base)
    return scored.drop("batch_id")


def stream_rejected(spark, base):
    _, rejected = _monitored(spark, base)
    return rejected.select("event_id", F.array_join("missing", ",").alias("missing"))


def stream_coverage(spark, base):
    """Every message in exactly one of the two outputs."""
    scored, rejected = _monitored(spark, base)
    both = scored.select("event_id", F.lit("scored").alias("outcome")).union(
        rejected.select("event_id", F.lit("rejected"))
    )
    return both.groupBy("outcome").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("event_id").alias("n_messages")
    )


def stream_scored_constant(spark, base):
    """Scored by forests of depth 0: the means of the labelled messages."""
    scored, _ = _monitored(spark, base, StreamTraining(CONSTANT))
    return _plain(scored.select("event_id", "Predicted_SBP", "Predicted_DBP"))


def stream_waited(spark, base):
    """A first batch without labels waits for the model; in the end every message has one outcome."""
    root = work_dir(spark, "stream-parts")
    messages = analogs.sensor_messages(read_table(spark, base, "events"))
    for part in (0, 1):
        messages.where((F.col("event_id") % 10 != 0).cast("int") == part).write.parquet(f"{root}/in/{part}")

    stream = spark.readStream.schema(messages.schema).option("maxFilesPerTrigger", 1)
    writer_root = f"{root}/job"
    for part in (0, 1):
        handler = scoring_handler(
            f"{writer_root}/scored",
            f"{writer_root}/rejected",
            ModelStore(f"{root}/model"),
            ["event_id"],
            StreamTraining(CONSTANT),
        )
        # Batch numbers go on where the first part's stopped.
        def shifted(batch, batch_id, handle=handler, first=1000 * part):
            handle(batch, first + batch_id)

        parsed = parse_messages(stream.parquet(f"{root}/in/{part}"), ["event_id"])
        drain(named_writer(parsed, f"{_query_name(root)}-{part}", f"{root}/checkpoints").foreachBatch(shifted))
    scored = spark.read.parquet(f"{writer_root}/scored")
    rejected = spark.read.parquet(f"{writer_root}/rejected")
    both = scored.select("event_id", F.lit("scored").alias("outcome"), (F.col("batch_id") == WAITED).alias("waited")).union(
        rejected.select("event_id", F.lit("rejected"), F.lit(False))
    )
    return both.groupBy("outcome").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("event_id").alias("n_messages"),
        F.count_if("waited").alias("n_waited"),
    )


def stream_committed(spark, base):
    """Every message with its outcome, from batches that are listed when complete; the stream runs twice."""
    root = work_dir(spark, "stream-committed")
    for run in range(2):
        drain(
            monitoring.monitor(
                _message_stream(spark, base),
                f"{_query_name(root)}-{run}",
                root,
                ModelStore(f"{root}/model"),
                keep=["event_id"],
                train_with=StreamTraining(CONSTANT),
                write=commit_batch,
            )
        )
    scored = read_committed(spark, f"{root}/scored", "event_id long")
    rejected = read_committed(spark, f"{root}/rejected", "event_id long")
    return scored.select("event_id", F.lit("scored").alias("outcome")).union(rejected.select("event_id", F.lit("rejected")))


def _scored_inline(spark, base, trained):
    root = work_dir(spark, "stream-inline")
    scored, _ = monitoring.scored_stream(_message_stream(spark, base), trained, ["event_id"])
    drain(
        named_writer(scored, _query_name(root), f"{root}/checkpoints")
        .format("parquet")
        .option("path", f"{root}/scored")
    )
    return spark.read.schema(scored.schema).parquet(f"{root}/scored")


def stream_scored_inline(spark, base):
    """Scored by a model trained beforehand, as plain expressions on the stream."""
    trained = model.train_dual_target(_labelled(spark, base), keys=["event_id"]).model
    return _scored_inline(spark, base, trained)


def stream_agrees_with_batch(spark, base):
    """Messages scored on the stream, and how many get the same scores as a table."""
    trained = model.train_dual_target(_labelled(spark, base), keys=["event_id"]).model
    usable, _ = quality.split_complete(_readings(spark, base), SENSOR_FEATURES)
    table = model.score_sensors(trained, usable, ["event_id"]).select(
        "event_id", F.col("Predicted_SBP").alias("sbp"), F.col("Predicted_DBP").alias("dbp")
    )
    both = _scored_inline(spark, base, trained).join(table, "event_id")
    same = (F.col("Predicted_SBP") == F.col("sbp")) & (F.col("Predicted_DBP") == F.col("dbp"))
    return both.agg(F.count(F.lit(1)).alias("n_scored"), F.count_if(same).alias("n_equal"))


QUERIES = {
    query.__name__: query
    for query in (
        item_groups,
        chart_extract,
        extract_filtered,
        extract_topn,
        extract_topn_most,
        classify_measurement,
        classify_by_dimension,
        vitals_pivot,
        weekly_vitals,
        demographics,
        age_at_admission,
        vitals_with_demographics,
        complete_vitals,
        feature_table,
        bucketed_features,
        bucketed_skewed_features,
        single_demographics,
        incremental_features,
        features_from_extract,
        weekly_features,
        skewed_extract,
        skewed_features,
        late_skew_features,
        repeated_dictionary,
        persisted_features,
        feature_sample,
        step_counts,
        observed_steps,
        quality_report,
        validated_counts,
        repeated_admissions,
        hash_split_counts,
        random_split_cover,
        grouped_split,
        mean_baseline_metrics,
        category_index,
        assembled_features,
        rf_metrics,
        rf_predictions,
        rf_feature_importance,
        rf_coverage,
        rf_constant,
        rf_constant_metrics,
        rf_stump,
        rf_stump_importance,
        rf_depth2,
        rf_expression_agreement,
        rf_four_importances,
        permutation_importance,
        batch_job,
        model_roundtrip,
        json_parse,
        rejected_messages,
        rejected_reasons,
        sensor_features,
        dual_target_predictions,
        dual_target_metrics,
        dual_target_coverage,
        dual_target_stump,
        csv_roundtrip,
        single_file_csv,
        predictions_file,
        jdbc_slices,
        quantile_slices,
        stream_parse,
        stream_batch_counts,
        stream_resumed,
        stream_observed_counts,
        stream_sample,
        stream_scored,
        stream_rejected,
        stream_coverage,
        stream_scored_constant,
        stream_waited,
        stream_committed,
        stream_scored_inline,
        stream_agrees_with_batch,
    )
}
