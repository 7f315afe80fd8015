"""SQL counterparts of the named queries, for an independent engine (DuckDB).

Written against the raw test tables only. Forest predictions have no SQL form;
their coverage queries do.
"""

from __future__ import annotations

# Fixed values, written out here so that they do not come from the code under test.
_GROUPS = {
    "Systolic BP": [6, 51, 455, 6701, 220050, 220179],
    "Diastolic BP": [8364, 8368, 8440, 8441, 8555, 220051, 220180],
    "MAP": [52, 456, 6702, 220052, 220181],
    "Heart Rate": [211, 220045],
}
_CODES = ", ".join(str(code) for codes in _GROUPS.values() for code in codes)
_EXTRACT = (
    "gender dob dod hadm_id admittime dischtime itemid charttime value valuenum valueuom error label unitname"
).split()


def _in(name):
    return f"itemid IN ({', '.join(map(str, _GROUPS[name]))})"


def _pick(name, index):
    codes = _GROUPS[name]
    return f"([{', '.join(map(str, codes))}])[{index} % {len(codes)} + 1]"


_BORN = "DATE '1930-01-01' + CAST(c_custkey * 37 % 25000 AS INTEGER)"

_PATIENTS = f"""patients AS (
  SELECT c_custkey AS subject_id, c_mktsegment AS gender,
         CASE WHEN c_custkey % 40 <> 7 THEN {_BORN} END AS dob,
         CASE WHEN c_custkey % 40 <> 7 AND c_custkey % 3 = 0 THEN {_BORN} + 29220 END AS dod
  FROM customer)"""

_D_ITEMS = f"""d_items AS (
  SELECT ([{_CODES}, 999])[p_partkey % 21 + 1] AS itemid,
         min(p_name) AS label, min(p_type) AS unitname
  FROM part GROUP BY 1)"""

_ORDER_HISTORY = f"""{_PATIENTS}, {_D_ITEMS},
admissions AS (
  SELECT o_custkey AS subject_id, o_orderkey AS hadm_id, CAST(o_orderdate AS DATE) AS admittime,
         CAST(o_orderdate AS DATE) + CAST(o_orderkey % 20 AS INTEGER) AS dischtime
  FROM orders),
chartevents AS (
  SELECT l_orderkey AS hadm_id,
         CASE WHEN l_linenumber IN (1, 2) THEN {_pick("Systolic BP", "l_partkey")}
              WHEN l_linenumber IN (3, 4) THEN {_pick("Diastolic BP", "l_partkey")}
              WHEN l_linenumber = 5 THEN {_pick("MAP", "l_partkey")}
              WHEN l_linenumber = 6 THEN {_pick("Heart Rate", "l_partkey")}
              WHEN l_partkey % 2 = 0 THEN 999 ELSE 442 END AS itemid,
         CAST(date_trunc('year', l_shipdate) AS DATE) AS charttime,
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS value,
         CASE WHEN l_suppkey % 13 <> 5 THEN l_quantity END AS valuenum,
         CASE WHEN l_linenumber = 6 THEN 'bpm' ELSE 'mmHg' END AS valueuom,
         CASE WHEN l_discount > 0.095 THEN '1' END AS error
  FROM lineitem)"""

_SKEWED_HISTORY = _ORDER_HISTORY.replace(
    "SELECT l_orderkey AS hadm_id",
    "SELECT CASE WHEN (l_partkey + l_suppkey) % 3 = 0 THEN 5 ELSE l_orderkey END AS hadm_id",
)

_MOVED = "(l_partkey + l_suppkey) % 20 = 0"
_LATE_KEY = f"CASE WHEN {_MOVED} THEN 5 ELSE l_orderkey END"
_LATE_HISTORY = (
    _ORDER_HISTORY.replace("SELECT l_orderkey AS hadm_id", f"SELECT {_LATE_KEY} AS hadm_id")
    .replace("date_trunc('year', l_shipdate)", "date_trunc('month', l_shipdate)")
    .replace(
        "WHEN l_linenumber = 6 THEN ([",
        f"WHEN l_linenumber = 6 AND ({_LATE_KEY} = 5 OR {_LATE_KEY} % 16 = 0) THEN ([",
    )
)

_TWICE_LISTED = _ORDER_HISTORY.replace("d_items AS (", "single_items AS (").replace(
    "admissions AS (", "d_items AS (SELECT * FROM single_items UNION ALL SELECT * FROM single_items WHERE itemid = 51),\nadmissions AS ("
)

_TWICE_BORN = _ORDER_HISTORY.replace("patients AS (", "single_patients AS (").replace(
    "admissions AS (",
    "patients AS (SELECT * FROM single_patients UNION ALL\n"
    "  SELECT subject_id, gender, dob + 100 AS dob, dod FROM single_patients WHERE subject_id % 5 = 0),\nadmissions AS (",
)

_EVENT_LOG = f"""{_PATIENTS}, {_D_ITEMS},
admissions AS (
  SELECT subject_id, subject_id AS hadm_id,
         DATE '2024-01-01' + CAST(subject_id % 7 AS INTEGER) AS admittime
  FROM patients),
chartevents AS (
  SELECT user_id AS hadm_id,
         CASE event_type WHEN 'click' THEN 51 WHEN 'view' THEN 8368 WHEN 'signup' THEN 52
                         WHEN 'purchase' THEN 211 WHEN 'error' THEN 999 END AS itemid,
         CAST(date_trunc('week', ts) AS DATE) AS charttime,
         value AS valuenum,
         CASE WHEN event_id % 29 = 3 THEN '1' END AS error
  FROM events)"""

_VALID = f"itemid IN ({_CODES}) AND error IS NULL AND valuenum IS NOT NULL"

_MEASUREMENT = f"""CASE WHEN {_in("Systolic BP")} THEN 'Systolic BP'
  WHEN {_in("Diastolic BP")} THEN 'Diastolic BP'
  WHEN {_in("MAP")} THEN 'MAP'
  WHEN {_in("Heart Rate")} THEN 'Heart Rate' ELSE 'Other' END"""

_WIDE = f"""wide AS (
  SELECT hadm_id, charttime,
         avg(valuenum) FILTER ({_in("Systolic BP")}) AS systolic_bp,
         avg(valuenum) FILTER ({_in("Diastolic BP")}) AS diastolic_bp,
         avg(valuenum) FILTER ({_in("MAP")}) AS map,
         avg(valuenum) FILTER ({_in("Heart Rate")}) AS heart_rate,
         count(*) AS n_readings
  FROM chartevents WHERE {_VALID} GROUP BY hadm_id, charttime)"""

_ROUNDED = ", ".join(
    f"round({c}, 6) AS {c}" for c in ("systolic_bp", "diastolic_bp", "map", "heart_rate")
)

_DEMO = """demo AS (
  SELECT DISTINCT hadm_id, gender, dob, admittime,
         datediff('day', dob, admittime) / 365.25 AS age
  FROM admissions JOIN patients USING (subject_id))"""

_COMPLETE = "systolic_bp IS NOT NULL AND diastolic_bp IS NOT NULL AND heart_rate IS NOT NULL"

_KNOWN = f"""{_WIDE.replace("FROM chartevents", "FROM chartevents SEMI JOIN d_items USING (itemid)")}"""


def _features(tables):
    return f"""WITH {tables}, {_KNOWN}, {_DEMO},
features AS (
  SELECT hadm_id, charttime, systolic_bp, diastolic_bp, map, heart_rate, gender, age
  FROM wide JOIN demo USING (hadm_id) WHERE {_COMPLETE})"""


_TWICE_COUNTED = _features(_TWICE_LISTED).replace("SEMI JOIN d_items", "JOIN d_items")
_FEATURE_ROWS = f"SELECT hadm_id, charttime, {_ROUNDED}, gender, round(age, 6) AS age FROM features"
_HISTORY_FEATURES = f"{_features(_ORDER_HISTORY)} {_FEATURE_ROWS}"
_WEEKLY_FEATURES = f"{_features(_EVENT_LOG)} {_FEATURE_ROWS}"


def _bucket(keys, seed=42):
    text = " || '|' || ".join([f"'{seed}'", *[f"CAST({key} AS VARCHAR)" for key in keys]])
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) % 10000"


_SPLIT = f"""{_features(_EVENT_LOG)},
parts AS (SELECT *, {_bucket(["hadm_id", "charttime"])} < 8000 AS training FROM features)"""

_BASELINE = f"""{_SPLIT},
scored AS (
  SELECT systolic_bp AS y, (SELECT avg(systolic_bp) FROM parts WHERE training) AS p
  FROM parts WHERE NOT training)"""

_DATED = ", ".join(
    f"CAST({c} AS DATE) AS {c}" if c in ("dob", "dod", "admittime", "dischtime", "charttime") else c
    for c in _EXTRACT
)

_JOINED = """patients JOIN admissions USING (subject_id)
  JOIN chartevents USING (hadm_id) JOIN d_items USING (itemid)"""

_READINGS = """readings AS (
  SELECT event_id,
         CASE WHEN good THEN CAST(value AS FLOAT) END AS PTT,
         CASE WHEN good
              THEN CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) / 8.0 AS FLOAT) END AS PIR,
         CASE WHEN good THEN CAST(user_id % 64 + 50 AS FLOAT) END AS HR,
         CASE WHEN good AND event_id % 10 <> 0 THEN CAST(event_id % 60 + 90 AS FLOAT) END AS SBP,
         CASE WHEN good AND event_id % 10 <> 0 THEN CAST(event_id % 40 + 60 AS FLOAT) END AS DBP
  FROM (SELECT *, event_type <> 'error' AS good FROM events))"""



_TRAINED = f"""{_SPLIT},
usable AS (SELECT * FROM parts WHERE age IS NOT NULL),
scored AS (
  SELECT hadm_id, charttime, systolic_bp AS y,
         (SELECT avg(systolic_bp) FROM usable WHERE training) AS p
  FROM usable WHERE NOT training)"""


def _stump(target):
    """Cuts between neighbouring values, the one that explains most, and the means on both sides."""
    return f"""{target}_cuts AS (
  SELECT v, (v + lead(v) OVER (ORDER BY v)) / 2 AS cut,
         sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER () AS nt, sum(s) OVER () AS st
  FROM (SELECT HR AS v, count(*) AS n, sum({target}) AS s FROM trained GROUP BY HR)
  WINDOW w AS (ORDER BY v)),
{target}_best AS (
  SELECT cut, sl / nl AS low, (st - sl) / (nt - nl) AS high
  FROM {target}_cuts WHERE cut IS NOT NULL
  ORDER BY sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) DESC LIMIT 1)"""


def _stump_score(target):
    return f"""round((SELECT CASE WHEN HR <= cut THEN low ELSE high END FROM {target}_best), 6) AS Predicted_{target}"""


def _as_doubles(names):
    return ", ".join(f"round(CAST({name} AS DOUBLE), 6) AS {name}" for name in names)


_READING_ROWS = f"""WITH {_READINGS}
SELECT event_id, {_as_doubles(["PTT", "PIR", "HR", "SBP", "DBP"])} FROM readings"""

_REJECTED = "SELECT event_id, 'PTT,PIR,HR' AS missing FROM events WHERE event_type = 'error'"

_SPEC = ", ".join(f"('{name}', '{','.join(map(str, codes))}')" for name, codes in _GROUPS.items())

_SUMMARIES = {
    "patients": ("customer", "subject_id, gender, dob, dod"),
    "admissions": ("orders", "subject_id, hadm_id, admittime, dischtime"),
    "chartevents": ("lineitem", "hadm_id, itemid, charttime, value, valuenum, valueuom, error"),
    "d_items": ("(SELECT DISTINCT p_partkey % 21 FROM part)", "itemid, label, unitname"),
}

_STUMPS = f"""WITH {_READINGS},
labelled AS (
  SELECT event_id, CAST(HR AS DOUBLE) AS HR, CAST(SBP AS DOUBLE) AS SBP, CAST(DBP AS DOUBLE) AS DBP,
         {_bucket(["event_id"])} < 8000 AS training
  FROM readings WHERE SBP IS NOT NULL),
trained AS (SELECT * FROM labelled WHERE training),
{_stump("SBP")},
{_stump("DBP")}"""

_TABLES = {"patients": "customer", "admissions": "orders", "chartevents": "lineitem"}

_ONE_DEMO = """demo AS (
  SELECT hadm_id, gender, datediff('day', dob, admittime) / 365.25 AS age
  FROM admissions JOIN patients USING (subject_id)
  QUALIFY row_number() OVER (PARTITION BY hadm_id ORDER BY gender NULLS FIRST, dob NULLS FIRST, admittime NULLS FIRST) = 1)"""

def _hash60(text):
    return f"CAST('0x' || substr(md5('42|' || CAST({text} AS VARCHAR)), 1, 15) AS BIGINT)"


def _value_of(feature, features):
    """The column that `feature` names."""
    return f"CASE {feature} {' '.join(_named(f) for f in features)} END"


def _named(feature):
    return f"WHEN '{feature}' THEN {feature}"


def _grown(name, source, features, target):
    """The split of `source` that explains most, over the cuts between values of all of `trained`; first of equals."""
    places = ", ".join(f"({i}, '{f}')" for i, f in enumerate(features))
    value = _value_of("f", features)
    return f"""{name}_all AS (
  SELECT i, f, v, (v + lead(v) OVER (PARTITION BY f ORDER BY v)) / 2 AS cut
  FROM (SELECT DISTINCT i, f, {value} AS v FROM trained, (VALUES {places}) features(i, f))),
{name}_sums AS (
  SELECT i, f, {value} AS v, count(*) AS n, sum({target}) AS s FROM {source}, (VALUES {places}) features(i, f) GROUP BY 1, 2, 3),
{name}_cuts AS (
  SELECT a.i, a.f, a.cut, sum(b.n) FILTER (b.v <= a.cut) AS nl, sum(b.s) FILTER (b.v <= a.cut) AS sl, sum(b.n) AS nt, sum(b.s) AS st
  FROM {name}_all a JOIN {name}_sums b ON a.f = b.f WHERE a.cut IS NOT NULL GROUP BY 1, 2, 3),
{name} AS (
  SELECT f, cut, sl / nl AS low, (st - sl) / (nt - nl) AS high
  FROM {name}_cuts WHERE nl > 0 AND nl < nt
  ORDER BY sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) DESC, i, cut LIMIT 1)"""


def _side(name, features):
    return f"{_value_of(f'(SELECT f FROM {name})', features)} <= (SELECT cut FROM {name})"


_TWO, _FOUR = ["HR", "PIR"], ["HR", "PIR", "phase", "step"]


def _depth2(target):
    top, low, high = f"{target}_top", f"{target}_low", f"{target}_high"
    return f"""{_grown(top, "trained", _TWO, target)},
{low}_rows AS (SELECT * FROM trained WHERE {_side(top, _TWO)}),
{high}_rows AS (SELECT * FROM trained WHERE NOT {_side(top, _TWO)}),
{_grown(low, f"{low}_rows", _TWO, target)},
{_grown(high, f"{high}_rows", _TWO, target)}"""


def _leaf(name):
    return f"CASE WHEN {_side(name, _TWO)} THEN (SELECT low FROM {name}) ELSE (SELECT high FROM {name}) END"


def _depth2_score(target):
    top = _side(f"{target}_top", _TWO)
    return f"round(CASE WHEN {top} THEN {_leaf(f'{target}_low')} ELSE {_leaf(f'{target}_high')} END, 6) AS Predicted_{target}"


_LABELLED = f"""WITH {_READINGS},
labelled AS (
  SELECT event_id, CAST(PTT AS DOUBLE) AS PTT, CAST(PIR AS DOUBLE) AS PIR, CAST(HR AS DOUBLE) AS HR,
         CAST(SBP AS DOUBLE) AS SBP, CAST(DBP AS DOUBLE) AS DBP, CAST(event_id % 30 AS DOUBLE) AS phase,
         floor(CAST(PTT AS DOUBLE) / 16) AS step, {_bucket(["event_id"])} < 8000 AS training
  FROM readings WHERE SBP IS NOT NULL),
trained AS (SELECT * FROM labelled WHERE training)"""

_PERMUTED = f"""{_LABELLED},
{_grown("best", "trained", _FOUR, "SBP")},
test AS (SELECT *, md5('42|' || CAST(event_id AS VARCHAR)) AS place FROM labelled WHERE NOT training),
dealt AS (
  SELECT *, CAST('0x' || substr(place, 1, 8) AS BIGINT) % (SELECT greatest(1, CAST(ceil(count(*) / 10000.0) AS BIGINT)) FROM test) AS g FROM test),
others AS (
  SELECT *, {", ".join(f"coalesce(lead({f}) OVER w, first_value({f}) OVER w) AS other_{f}" for f in _FOUR)}
  FROM dealt WINDOW w AS (PARTITION BY g ORDER BY place, event_id)),
mixed AS (
  SELECT feature, SBP, {", ".join(f"CASE WHEN feature = '{f}' THEN other_{f} ELSE {f} END AS {f}" for f in _FOUR)}
  FROM others, (VALUES (''), {", ".join(f"('{f}')" for f in _FOUR)}) changed(feature)),
errors AS (
  SELECT feature, avg((SBP - p) * (SBP - p)) AS mse
  FROM (SELECT *, CASE WHEN {_side("best", _FOUR)} THEN (SELECT low FROM best) ELSE (SELECT high FROM best) END AS p FROM mixed)
  GROUP BY feature)
SELECT CAST(row_number() OVER (ORDER BY round(e.mse - b.mse, 9) DESC, e.feature) AS INTEGER) AS rank, e.feature,
       round(e.mse, 6) AS mse, round(e.mse - b.mse, 6) AS importance
FROM errors e JOIN errors b ON b.feature = '' WHERE e.feature <> ''"""

ORACLE_SQL = {
    "rf_depth2": f"""{_LABELLED}, {_depth2("SBP")}, {_depth2("DBP")}
SELECT event_id, {_depth2_score("SBP")}, {_depth2_score("DBP")} FROM labelled WHERE NOT training""",
    "rf_expression_agreement": """SELECT count(*) AS n_scored, count(*) AS n_equal
FROM events WHERE event_type <> 'error'""",
    "rf_four_importances": f"""{_LABELLED}, {_grown("best", "trained", _FOUR, "SBP")}
SELECT CAST(row_number() OVER (ORDER BY (f = name) DESC, name) AS INTEGER) AS rank, name AS feature,
       CASE WHEN f = name THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS importance
FROM best, (VALUES {", ".join(f"('{f}')" for f in _FOUR)}) names(name)""",
    "permutation_importance": _PERMUTED,
    "grouped_split": f"""WITH hashed AS (
  SELECT s, row_number() OVER (ORDER BY {_hash60("s")}, s) AS place, count(*) OVER () AS n FROM (SELECT DISTINCT o_custkey AS s FROM orders)),
parts AS (SELECT o_custkey AS s, CASE WHEN place <= floor(0.8 * n + 0.5) THEN 'train' ELSE 'test' END AS part
          FROM orders JOIN hashed ON s = o_custkey)
SELECT part, count(*) AS n_rows, count(DISTINCT s) AS n_patients, CAST(0 AS BIGINT) AS n_in_both FROM parts GROUP BY part""",
    "rejected_reasons": """SELECT event_id,
  CASE event_id % 7 WHEN 0 THEN '*:not json' WHEN 1 THEN '*:not json' WHEN 2 THEN 'HR:wrong type' WHEN 3 THEN 'HR:wrong case'
       ELSE 'PTT:missing,HR:missing' END AS reasons,
  CASE event_id % 7 WHEN 0 THEN 'no json' WHEN 1 THEN '{"PTT":' || event_id || ',"PIR":0.5'
       WHEN 2 THEN '{"PTT":' || event_id || ',"PIR":0.5,"HR":"fast"}'
       WHEN 3 THEN '{"PTT":' || event_id || ',"PIR":0.5,"hr":' || (user_id % 64 + 50) || '}'
       ELSE '{"HR":null,"PIR":0.5}' END AS raw
FROM events WHERE event_id % 7 < 5""",
    "quantile_slices": """SELECT method, count(*) AS n_rows, count(*) AS n_taken_once, method = 'quantile' AS even
FROM orders, (VALUES ('range'), ('quantile')) methods(method) GROUP BY method""",
    "stream_observed_counts": "SELECT count(*) AS n_records FROM events",
    "stream_sample": f"""SELECT event_id FROM (SELECT event_id FROM events WHERE event_type <> 'error' AND event_id % 10 <> 0)
ORDER BY {_hash60("event_id")}, event_id LIMIT 200""",
    "bucketed_features": _HISTORY_FEATURES,
    "bucketed_skewed_features": f"{_features(_SKEWED_HISTORY)} {_FEATURE_ROWS}",
    "single_demographics": f"{_features(_TWICE_BORN)} {_FEATURE_ROWS}".replace(_DEMO, _ONE_DEMO),
    "incremental_features": _WEEKLY_FEATURES,
    "stream_committed": """SELECT event_id, CASE WHEN event_type = 'error' THEN 'rejected' ELSE 'scored' END AS outcome FROM events""",
    "late_skew_features": f"{_features(_LATE_HISTORY)} {_FEATURE_ROWS}",
    "repeated_dictionary": f"""{_TWICE_COUNTED}
SELECT form, {_FEATURE_ROWS.removeprefix("SELECT ").removesuffix(" FROM features")}
FROM features, (VALUES ('direct'), ('joined')) forms(form)""",
    "extract_topn_most": f"""WITH {_ORDER_HISTORY} SELECT {_DATED} FROM {_JOINED} WHERE {_VALID}
ORDER BY hadm_id, charttime, itemid, gender NULLS FIRST, dob NULLS FIRST, dod NULLS FIRST,
  admittime, dischtime, value, valuenum, valueuom, error, label, unitname LIMIT 30000""",
    "validated_counts": " UNION ALL ".join(
        [f"SELECT '{name}' AS name, count(*) AS n_rows FROM {table}" for name, table in _TABLES.items()]
        + ["SELECT 'd_items' AS name, count(DISTINCT p_partkey % 21) AS n_rows FROM part"]
    ),
    "rf_constant": f"""{_TRAINED}
SELECT hadm_id, charttime, round(y, 6) AS systolic_bp, round(p, 6) AS prediction FROM scored""",
    "rf_constant_metrics": f"""{_TRAINED}
SELECT count(*) AS n_rows, round(avg(abs(y - p)), 6) AS mae,
       round(sqrt(avg((y - p) * (y - p))), 6) AS rmse,
       round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2
FROM scored""",
    "rf_stump": f"{_STUMPS} SELECT event_id, {_stump_score('SBP')} FROM labelled WHERE NOT training",
    "dual_target_stump": f"""{_STUMPS}
SELECT event_id, {_stump_score("SBP")}, {_stump_score("DBP")} FROM labelled WHERE NOT training""",
    "rf_stump_importance": "SELECT 1 AS rank, 'HR' AS feature, CAST(1 AS DOUBLE) AS importance",
    "batch_job": f"""{_features(_EVENT_LOG)},
parts AS (
  SELECT *, {_bucket(["hadm_id", "epoch_us(CAST(charttime AS TIMESTAMP))"])} < 8000 AS training FROM features)
SELECT count(*) AS n_features, count(*) FILTER (NOT training AND age IS NOT NULL) AS n_predictions,
       CAST(1 AS BIGINT) AS n_values
FROM parts""",
    "single_file_csv": f"""{_features(_EVENT_LOG)}
SELECT count(*) AS n_rows, CAST(1 AS BIGINT) AS n_files FROM features""",
    "stream_scored_constant": f"""WITH {_READINGS}
SELECT event_id, round((SELECT avg(SBP) FROM readings), 6) AS Predicted_SBP,
       round((SELECT avg(DBP) FROM readings), 6) AS Predicted_DBP
FROM readings WHERE PTT IS NOT NULL""",
    "stream_waited": """SELECT CASE WHEN event_type = 'error' THEN 'rejected' ELSE 'scored' END AS outcome,
       count(*) AS n_rows, count(DISTINCT event_id) AS n_messages,
       count(*) FILTER (event_type <> 'error' AND event_id % 10 = 0) AS n_waited
FROM events GROUP BY 1""",
    "item_groups": f"""WITH {_ORDER_HISTORY},
spec(measurement, codes) AS (VALUES {_SPEC}),
groups AS (
  SELECT measurement, CAST(trim(code) AS INTEGER) AS itemid
  FROM (SELECT measurement, unnest(string_split(codes, ',')) AS code FROM spec))
SELECT measurement, itemid, count(*) AS n_readings
FROM chartevents JOIN groups USING (itemid) GROUP BY measurement, itemid""",
    "chart_extract": f"WITH {_ORDER_HISTORY} SELECT {_DATED} FROM {_JOINED}",
    "extract_filtered": f"WITH {_ORDER_HISTORY} SELECT {_DATED} FROM {_JOINED} WHERE {_VALID}",
    "extract_topn": f"""WITH {_ORDER_HISTORY} SELECT {_DATED} FROM {_JOINED} WHERE {_VALID}
ORDER BY hadm_id, charttime, itemid, gender NULLS FIRST, dob NULLS FIRST, dod NULLS FIRST,
  admittime, dischtime, value, valuenum, valueuom, error, label, unitname LIMIT 1000""",
    "classify_measurement": f"""WITH {_ORDER_HISTORY}
SELECT hadm_id, charttime, itemid, valuenum, {_MEASUREMENT} AS measurement
FROM chartevents WHERE {_MEASUREMENT} <> 'Other'""",
    "classify_by_dimension": f"""WITH {_ORDER_HISTORY}
SELECT {_MEASUREMENT} AS measurement, count(*) AS n_readings, count(valuenum) AS n_values,
       round(sum(valuenum), 6) AS total
FROM chartevents GROUP BY 1""",
    "vitals_pivot": f"WITH {_ORDER_HISTORY}, {_WIDE} SELECT hadm_id, charttime, {_ROUNDED} FROM wide",
    "weekly_vitals": f"WITH {_EVENT_LOG}, {_WIDE} SELECT hadm_id, charttime, {_ROUNDED} FROM wide",
    "demographics": f"""WITH {_ORDER_HISTORY}, {_DEMO}
SELECT hadm_id, gender, round(age, 6) AS age FROM demo""",
    "age_at_admission": f"""WITH {_ORDER_HISTORY}
SELECT hadm_id, admittime AS admitted, dob AS born, datediff('day', dob, admittime) AS days,
       round(datediff('day', dob, admittime) / 365.25, 6) AS age
FROM admissions JOIN patients USING (subject_id)""",
    "vitals_with_demographics": f"""WITH {_ORDER_HISTORY}, {_WIDE}, {_DEMO}
SELECT hadm_id, charttime, {_ROUNDED}, gender, round(age, 6) AS age
FROM wide JOIN demo USING (hadm_id)""",
    "complete_vitals": f"""WITH {_ORDER_HISTORY}, {_WIDE}
SELECT hadm_id, charttime, {_ROUNDED} FROM wide WHERE {_COMPLETE}""",
    "feature_table": _HISTORY_FEATURES,
    "features_from_extract": _HISTORY_FEATURES,
    "skewed_extract": f"WITH {_SKEWED_HISTORY} SELECT {_DATED} FROM {_JOINED} WHERE {_VALID}",
    "skewed_features": f"{_features(_SKEWED_HISTORY)} {_FEATURE_ROWS}",
    "persisted_features": _HISTORY_FEATURES,
    "weekly_features": _WEEKLY_FEATURES,
    "feature_sample": f"{_WEEKLY_FEATURES} ORDER BY hadm_id, charttime LIMIT 10",
    "step_counts": f"""WITH {_ORDER_HISTORY}, {_WIDE}
SELECT CAST(sum(n_readings) AS BIGINT) AS n_readings, count(*) AS n_observations,
       count(*) FILTER ({_COMPLETE}) AS n_complete
FROM wide""",
    "quality_report": " UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS n_rows, "
        f"CAST({columns.count(',') + 1} AS BIGINT) AS n_cols, '{columns}' AS columns FROM {table}"
        for name, (table, columns) in _SUMMARIES.items()
    ),
    "repeated_admissions": """SELECT o_custkey AS subject_id, count(*) AS n_rows
FROM orders GROUP BY o_custkey HAVING count(*) > 1""",
    "hash_split_counts": f"""{_SPLIT}
SELECT CASE WHEN training THEN 'train' ELSE 'test' END AS part, count(*) AS n_rows
FROM parts GROUP BY 1""",
    "random_split_cover": f"""{_features(_EVENT_LOG)}
SELECT count(*) AS n_rows, count(DISTINCT (hadm_id, charttime)) AS n_observations FROM features""",
    "mean_baseline_metrics": f"""{_BASELINE}
SELECT count(*) AS n_rows, round(avg(abs(y - p)), 6) AS mae,
       round(sqrt(avg((y - p) * (y - p))), 6) AS rmse,
       round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2
FROM scored""",
    "predictions_file": f"""{_BASELINE}
SELECT round(y, 6) AS label, round(p, 6) AS prediction FROM scored""",
    "category_index": f"""{_features(_EVENT_LOG)}
SELECT gender, CAST(row_number() OVER (ORDER BY count(*) DESC, gender) - 1 AS DOUBLE) AS gender_index,
       count(*) AS n_rows
FROM features GROUP BY gender""",
    "assembled_features": f"""{_features(_EVENT_LOG)},
ranks AS (
  SELECT gender, row_number() OVER (ORDER BY count(*) DESC, gender) - 1 AS place
  FROM features GROUP BY gender)
SELECT hadm_id, charttime, round(diastolic_bp, 6) AS diastolic_bp,
       round(heart_rate, 6) AS heart_rate, CAST(place AS DOUBLE) AS gender_index,
       round(age, 6) AS age
FROM features JOIN ranks USING (gender) WHERE age IS NOT NULL""",
    "rf_coverage": f"""{_SPLIT}
SELECT count(*) AS n_scored, count(*) AS n_in_range
FROM parts WHERE NOT training AND age IS NOT NULL""",
    "model_roundtrip": f"""{_SPLIT}
SELECT count(*) AS n_scored, count(*) AS n_equal
FROM parts WHERE NOT training AND age IS NOT NULL""",
    "json_parse": _READING_ROWS,
    "stream_parse": _READING_ROWS,
    "rejected_messages": _REJECTED,
    "stream_rejected": _REJECTED,
    "sensor_features": f"""WITH {_READINGS}
SELECT event_id, {_as_doubles(["PTT", "PIR", "HR"])} FROM readings WHERE PTT IS NOT NULL""",
    "dual_target_coverage": f"""WITH {_READINGS}
SELECT count(*) AS n_scored, count(DISTINCT event_id) AS n_readings, count(*) AS n_with_both
FROM readings WHERE SBP IS NOT NULL AND {_bucket(["event_id"])} >= 8000""",
    "csv_roundtrip": _WEEKLY_FEATURES,
    "jdbc_slices": " UNION ALL ".join(
        f"SELECT '{method}' AS method, count(*) AS n_rows, count(*) AS n_taken_once, "
        "CAST(8 AS BIGINT) AS n_slices FROM orders"
        for method in ("range", "modulus")
    ),
    "stream_batch_counts": """SELECT event_type, count(*) AS n_records
FROM events GROUP BY event_type""",
    "stream_resumed": """SELECT event_type, count(*) AS n_records
FROM events GROUP BY event_type""",
    "stream_agrees_with_batch": """SELECT count(*) AS n_scored, count(*) AS n_equal
FROM events WHERE event_type <> 'error'""",
    "stream_coverage": """SELECT CASE WHEN event_type = 'error' THEN 'rejected' ELSE 'scored' END AS outcome,
       count(*) AS n_rows, count(DISTINCT event_id) AS n_messages
FROM events GROUP BY 1""",
}
ORACLE_SQL["observed_steps"] = ORACLE_SQL["step_counts"]
