"""From raw documents to packed training sequences, stage by stage.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the
last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.llm.decontamination import decontaminate
from pulseframe.llm.line_dedup import line_dedup
from pulseframe.llm.ngram_join import ngram_join
from pulseframe.llm.packing import pack
from pulseframe.llm.quality_gam import quality_filter
from pulseframe.llm.ship import ship
from pulseframe.staging import stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model, fitted to the labels, does not reject; all of them where it could not learn."""
    ship(spark)
    return quality_filter(docs.select(COLUMNS), _table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without line blocks of earlier documents; a document that loses all its lines goes.

    A null text is empty here. A row without an id is not earlier or later than any other and stays as it is.
    """
    ship(spark)
    docs = docs.select(COLUMNS)
    done = line_dedup(docs, carry=["lang", "source", "n_chars"], every=True)
    changed = F.col("n_removed") > 0
    kept = done.where(~changed | (F.col("n_removed") < F.col("n_lines"))).select(
        "doc_id",
        F.col("kept").alias("text"),
        "rest.lang",
        "rest.source",
        F.when(changed, F.length("kept").cast("long")).otherwise(F.col("rest.n_chars")).alias("n_chars"),
    )
    return kept.union(docs.where("doc_id IS NULL"))


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest id.

    Rows are judged, not ids: rows that share an id, or have none, stay if their texts differ. Of equal rows one
    stays. Texts without words are like no other and all stay.
    """
    ship(spark)
    docs = docs.select(COLUMNS)
    odd = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR doc_id IS NULL")
    if odd.isEmpty():
        later = ngram_join(docs).where("component_id <> doc_id").select("doc_id")
        return docs.join(later, "doc_id", "left_anti")
    # A name for each row: rows of one name are equal in id and text.
    named = docs.withColumn("_row", F.xxhash64("doc_id", "text"))
    found = stage(ngram_join(named, id_column="_row").select(F.col("doc_id").alias("_row"), "n_shingles", "component_id").distinct(), "similar-rows")
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "_row")
    first = named.join(found.where("n_shingles > 0"), "_row").groupBy("component_id").agg(F.min(place).alias("first")).select("first._row")
    one = named.join(first, "_row", "left_semi").groupBy("_row").agg(F.min(F.struct(*COLUMNS)).alias("rest")).select("rest.*")
    wordless = found.where("n_shingles = 0").select("_row")
    return one.union(named.join(wordless, "_row", "left_semi").select(COLUMNS))


def drop_benchmark_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lies in benchmark passages; rows without an id or a text stay."""
    return decontaminate(docs.select(COLUMNS), _table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in the training sequences; a null text is an empty one."""
    ship(spark)
    return pack(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", keep_one_of_similar),
    ("benchmark decontamination", drop_benchmark_texts),
    ("best-fit packing", pack_sequences),
]

#: The classifier's scores and the packing have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
