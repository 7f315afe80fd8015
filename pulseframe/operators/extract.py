"""The relational extract: four tables -> one row per valid reading."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.operators.joins import (
    BROADCAST_BYTES,
    ROW,
    SKETCH_GROUPS,
    fits_broadcast,
    frequent_keys_of,
    is_unique,
    join_by_key,
    numbered,
)
from pulseframe.schemas import ClinicalTables
from pulseframe.staging import stage

# Columns and order of the extract.
EXTRACT_COLUMNS = [
    "gender", "dob", "dod",
    "hadm_id", "admittime", "dischtime",
    "itemid", "charttime", "value", "valuenum", "valueuom", "error",
    "label", "unitname",
]

KEY_BINS = 1024
# The quantile sketch's size; its error is about a thousandth of the rows.
SKETCH_K = 4096
SKETCH_MARGIN = 0.002
# Stands for a missing time, which sorts first.
EARLIEST = -(1 << 62)

# What preprocess_extract needs of them.
FEATURE_COLUMNS = ["hadm_id", "charttime", "itemid", "valuenum", "gender", "dob", "admittime"]


def valid_readings(chartevents: DataFrame, codes: Sequence[int]) -> DataFrame:
    """Listed codes with a number and no error flag; all three reach the scan."""
    return chartevents.where(
        F.col("itemid").isin(list(codes))
        & F.col("error").isNull()
        & F.col("valuenum").isNotNull()
    )


def stays(tables: ClinicalTables, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Admissions with their patient; a patient may own any share of the admissions."""
    return join_by_key(
        numbered(tables.admissions),
        tables.patients,
        "subject_id",
        spread_by=[ROW],
        broadcast_bytes=broadcast_bytes,
    ).drop(ROW)


def stays_are_small(tables: ClinicalTables, limit: int = BROADCAST_BYTES) -> bool:
    """Whether admissions with their patient may be broadcast.

    If each patient has one row, the join has no more rows than the admissions,
    so the two tables' sizes bound it. That is checked, on small tables only:
    repeated patients could multiply two small tables into a large one.
    """
    both = [tables.admissions, tables.patients]
    return fits_broadcast(both, limit) and is_unique(tables.patients, "subject_id")


def join_clinical_tables(
    tables: ClinicalTables, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Readings with item, admission and patient, 14 columns.

    The small tables are joined with each other first, so the readings cross
    the network once at most.
    """
    small_items = fits_broadcast([tables.d_items], broadcast_bytes)
    small_stays = stays_are_small(tables, broadcast_bytes)
    # The dictionary keeps or repeats readings, so both keys can be counted on them, in one pass.
    shuffled = [k for k, small in (("itemid", small_items), ("hadm_id", small_stays)) if not small]
    hot = frequent_keys_of(tables.chartevents, shuffled) if shuffled else {}
    labelled = join_by_key(
        numbered(tables.chartevents),
        tables.d_items,
        "itemid",
        spread_by=[ROW],
        small=small_items,
        hot=hot.get("itemid"),
        broadcast_bytes=broadcast_bytes,
    )
    return join_by_key(
        labelled,
        stays(tables, broadcast_bytes),
        "hadm_id",
        spread_by=[ROW],
        small=small_stays,
        hot=hot.get("hadm_id"),
        broadcast_bytes=broadcast_bytes,
    ).select(EXTRACT_COLUMNS)


def in_chart_order(
    extract: DataFrame, lead: Sequence[str] = ("hadm_id", "charttime", "itemid")
) -> DataFrame:
    """By admission and time; the other columns break ties, so the order is total."""
    return extract.orderBy(*lead, *[name for name in extract.columns if name not in lead])


def clinical_extract(
    tables: ClinicalTables,
    codes: Sequence[int],
    limit: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Valid readings of the listed codes, joined.

    With `limit`, the first rows in chart order. Ties are broken by every
    column, so reading the result twice gives the same rows.
    """
    narrowed = ClinicalTables(
        tables.patients,
        tables.admissions,
        valid_readings(tables.chartevents, codes),
        tables.d_items,
    )
    extract = join_clinical_tables(narrowed, broadcast_bytes)
    if limit is None:
        return extract
    # The dictionary may drop or repeat readings, and admissions may lack; the cut counts what is left.
    return first_in_chart_order(extract, limit, narrowed.chartevents.select("hadm_id"))


def key_bound(keys: DataFrame, key: str, rank: int, margin: float = SKETCH_MARGIN) -> int | None:
    """A key at or above the `rank`th one in order, most likely; None if there may be no such key.

    Quantile sketches are built where the rows are and merged in two levels, so one small row reaches the driver whatever
    the input. The place asked for is `margin` of all rows beyond `rank`, more than the sketch's usual error.
    """
    group = F.spark_partition_id() % SKETCH_GROUPS
    local = keys.groupBy(group.alias("group")).agg(
        F.kll_sketch_agg_bigint(F.col(key).cast("long"), SKETCH_K).alias("sketch"), F.count(key).alias("n")
    )
    # Grouping by a constant leaves an empty input empty: there is no sketch to merge.
    merged = local.groupBy(F.lit(1).alias("all")).agg(F.kll_merge_agg_bigint("sketch", SKETCH_K).alias("sketch"), F.sum("n").alias("n"))
    row = merged.first()
    place = 1.0 if row is None or not row["n"] else rank / row["n"] + margin
    if place >= 1.0:
        return None
    # The place must be a constant, so the merged sketch comes back as one.
    at = F.kll_sketch_get_quantile_bigint(F.lit(bytes(row["sketch"])), F.lit(place))
    return keys.sparkSession.range(1).select(at.alias("bound")).first()["bound"]


def first_in_chart_order(extract: DataFrame, limit: int, keys: DataFrame | None = None) -> DataFrame:
    """The first `limit` rows in chart order; only about so many are joined and sorted.

    A sort with a limit would send that many rows of every task to a single one. A quantile sketch of the
    admissions says about where the limit falls instead; the rows up to there are written, counted, and cut exactly. `keys` has a
    column hadm_id with about the admissions of the extract's rows, where it costs less than these. If the sketch was too low, more is
    written.
    """
    if limit <= 0:
        return extract.limit(0)
    keys = extract.select("hadm_id") if keys is None else keys
    margin = SKETCH_MARGIN
    while True:
        bound = key_bound(keys, "hadm_id", limit, margin)
        rows = stage(extract if bound is None else extract.where(F.col("hadm_id") <= bound), "first-rows")
        cut = _cut(rows, limit)
        if cut is not None:
            return cut
        if bound is None:
            return in_chart_order(rows)
        margin *= 8


def _cut(rows: DataFrame, limit: int) -> DataFrame | None:
    """The first rows of a written table: by admission, then by time, then sorted; None if there are fewer than `limit`."""
    instant = F.coalesce(F.unix_micros("charttime"), F.lit(EARLIEST))
    counts = stage(rows.groupBy("hadm_id", instant.alias("at")).agg(F.count(F.lit(1)).alias("n")), "instants")
    last, before = key_at(counts.groupBy("hadm_id").agg(F.sum("n").alias("n")), "hadm_id", limit)
    if last is None:
        return None if before < limit else in_chart_order(rows)
    until, _ = key_at(counts.where(F.col("hadm_id") == last).select("at", "n"), "at", limit - before)
    inside = (F.col("hadm_id") < last) | ((F.col("hadm_id") == last) & (instant <= until))
    return in_chart_order(rows.where(inside)).limit(limit)


def key_at(counts: DataFrame, key: str, rank: int, few: int = 4 * KEY_BINS) -> tuple[int | None, int]:
    """The least key up to which `counts` (key, n) sum to `rank` or more, and the sum below it.

    (None, sum of all) if they hold less. The range of keys is cut into KEY_BINS, the bin at which the rank
    falls is cut again, and so on; each step brings one row per bin to the driver. Counts with no more rows than a
    few bins are cut at once.
    """
    low, high, total, rows = counts.agg(F.min(key), F.max(key), F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    if total < rank:
        return None, total
    below = 0
    if rows <= few:
        for row in sorted(counts.select(key, "n").collect()):
            if below + row["n"] >= rank:
                return row[key], below
            below += row["n"]
    while low < high:
        width = (high - low) // KEY_BINS + 1
        inside = counts.where(F.col(key).between(low, high))
        bins = inside.groupBy(F.expr(f"(`{key}` - {low}L) div {width}L").alias("bin")).agg(F.sum("n").alias("n"))
        for row in sorted(bins.collect()):
            if below + row["n"] >= rank:
                low, high = low + row["bin"] * width, min(high, low + (row["bin"] + 1) * width - 1)
                break
            below += row["n"]
    return low, below
