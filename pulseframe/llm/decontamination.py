"""Removal of benchmark passages from documents, with DataFrame operations only.

A window is `size` consecutive words of a benchmark item. Every occurrence of it in a document
holds a whole anchor, about half as long, at one of the places that are multiples of a stride. So
documents look up only every stride-th anchor in the broadcast hash set of the benchmark's
anchors; around each hit the windows are compared as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseframe.staging import stage

#: Fixed value: characters between words. A-Z belong to words, whose case is folded afterwards.
GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Benchmark windows or anchors up to this number (about 100 MB) are broadcast; beyond it the same join is shuffled.
MOST_BROADCAST = 1_000_000


def words_of(text: Column) -> Column:
    """The words in order; none for a null text. Only the first and last piece of a split can be empty."""
    pieces = F.split(F.coalesce(text.cast("string"), F.lit("")), GAPS)
    skip = F.when(F.element_at(pieces, 1) == "", 1).otherwise(0)
    drop = F.when((F.size(pieces) > skip) & (F.element_at(pieces, -1) == ""), 1).otherwise(0)
    return F.slice(pieces, skip + 1, F.size(pieces) - skip - drop)


def _folded(words: Column) -> Column:
    return F.translate(F.array_join(words, " "), UPPER, LOWER)


def _starts(n: Column, length: int, stride: int) -> Column:
    """0, stride, 2 * stride, ... as far as `length` words fit."""
    return F.when(n >= length, F.sequence(F.lit(0), n - length, F.lit(stride))).otherwise(F.array().cast("array<int>"))


def _anchors(words: Column, n: Column, length: int, stride: int) -> Column:
    """Places and hashes of anchors; the hash folds case more widely than words do, which only adds candidates."""
    return F.transform(
        _starts(n, length, stride),
        lambda i: F.struct(i.alias("at"), F.xxhash64(F.lower(F.array_join(F.slice(words, i + 1, length), " "))).alias("anchor")),
    )


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= MOST_BROADCAST else df


def benchmark_windows(benchmark: DataFrame, size: int, id_column: str, text: str) -> DataFrame:
    """(item, length, window): every window of every item; an item of fewer words is one window."""
    split = benchmark.select(F.col(id_column).cast("string").alias("item"), words_of(F.col(text)).alias("words")).where("size(words) > 0")
    n = F.least(F.size("words"), F.lit(size))
    starts = F.sequence(F.lit(0), F.size("words") - n)
    return (
        split.withColumn("length", n)
        .select("item", "length", "words", F.explode(starts).alias("at"))
        .select("item", "length", _folded(F.slice("words", F.col("at") + 1, F.col("length"))).alias("window"))
        .distinct()
    )


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = 13,
    id_column: str = "doc_id",
    text: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items, spans for every document.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII; A-Z are
    lower-cased. A document's word is hit if it lies in an occurrence of a benchmark window. `items`
    are the ids, as sorted strings, of the items that have an occurring window; `spans` the
    occurring windows as (start, length) in words.

    A null text has no words. Items without words, or without an id, have no windows. Rows that
    share an id are judged each by its own text. Rows without an id are left out: nothing names
    them. Other columns are ignored.
    """
    windows = stage(
        benchmark_windows(benchmark.where(F.col(item_column).isNotNull()), size, item_column, item_text), "benchmark-windows"
    )
    lengths = sorted(row["length"] for row in windows.select("length").distinct().collect())  # at most `size` numbers
    source = docs.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    split = source.select("doc_id", words_of(F.col("text")).alias("words"))

    found = None
    for length in lengths:
        anchor = (length + 1) // 2
        stride = length - anchor + 1
        known = windows.where(F.col("length") == length).select(F.split("window", " ").alias("w"))
        known = known.select(F.explode(_anchors(F.col("w"), F.size("w"), anchor, 1)).alias("a")).select(F.col("a.anchor").alias("anchor")).distinct()
        looked = split.select("doc_id", F.explode(_anchors(F.col("words"), F.size("words"), anchor, stride)).alias("a"))
        looked = looked.select("doc_id", F.col("a.at").alias("at"), F.col("a.anchor").alias("anchor"))
        hit = looked.join(_small(known), "anchor", "left_semi").select(
            "doc_id", F.lit(length).alias("length"), F.explode(F.sequence(F.col("at") - (stride - 1), F.col("at"))).alias("start")
        )
        found = hit if found is None else found.union(hit)
    if found is None:
        found = source.select("doc_id", F.lit(0).alias("length"), F.lit(0).alias("start")).limit(0)
    near = found.where("start >= 0").groupBy("doc_id").agg(F.collect_set(F.struct("length", "start")).alias("near"))

    # The words of a text are split once more here, where its candidates meet it.
    met = source.join(near, "doc_id", "left").select("doc_id", words_of(F.col("text")).alias("words"), "near")
    inside = F.filter("near", lambda c: c["start"] + c["length"] <= F.size("words"))
    asked = F.transform(
        inside, lambda c: F.struct(c["length"].alias("length"), c["start"].alias("start"), _folded(F.slice("words", c["start"] + 1, c["length"])).alias("window"))
    )
    rows = met.select("doc_id", F.size("words").cast("long").alias("n_words"), asked.alias("asked"))
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "benchmark-candidates")

    candidates = rows.where("size(asked) > 0").select("row", F.explode("asked").alias("a")).select("row", "a.length", "a.start", "a.window")
    verified = candidates.join(_small(windows), ["window", "length"])
    covered = F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1)))))
    hits = (
        verified.groupBy("row")
        .agg(F.collect_set(F.struct("start", "length")).alias("spans"), F.sort_array(F.collect_set("item")).alias("items"))
        .select("row", "spans", "items", covered.cast("long").alias("n_hit"))
    )
    none = F.array().cast("array<string>")
    return rows.select("row", "doc_id", "n_words").join(hits, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", none).alias("items"),
        "spans",
    )


def is_contaminated(n_hit: Column, n_words: Column, share: int = 20) -> Column:
    """At least one word in `share` is hit."""
    return (n_hit > 0) & (n_hit * share >= n_words)


def decontaminate(docs: DataFrame, benchmark: DataFrame, share: int = 20, id_column: str = "doc_id", **settings) -> DataFrame:
    """The documents that are not contaminated, with all their columns; rows without an id stay."""
    found = find_contamination(docs, benchmark, id_column=id_column, **settings)
    gone = found.where(is_contaminated(F.col("n_hit"), F.col("n_words"), share)).select(F.col("doc_id").alias(id_column)).distinct()
    return docs.join(gone, id_column, "left_anti")
