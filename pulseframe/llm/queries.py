"""Named queries of the corpus operators; each takes (spark, folder) and reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseframe.llm.decontamination import find_contamination, is_contaminated
from pulseframe.llm.lexical_search import lexical_search
from pulseframe.llm.line_dedup import line_dedup
from pulseframe.llm.minhash_dedup import minhash_dedup
from pulseframe.llm.ngram_join import ngram_join
from pulseframe.llm.oracle import ORACLE_SQL  # noqa: F401
from pulseframe.llm.packing import pack
from pulseframe.llm.phrase_mining import phrase_mining
from pulseframe.llm.quality_gam import quality_scores
from pulseframe.llm.secret_scan import digest, secret_scan
from pulseframe.llm.ship import ship
from pulseframe.llm.substring_dedup import substring_dedup
from pulseframe.llm.suffix_dedup import suffix_dedup
from pulseframe.llm.token_counts import token_counts
from pulseframe.llm.top_k import top_k


def _read(spark: SparkSession, base: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def _sha256(column: str):
    return F.sha2(F.col(column).cast("binary"), 256)


def op1_ngram_jaccard_join(spark: SparkSession, base: str) -> DataFrame:
    return ngram_join(_read(spark, base, "documents"))


def op2_quality_classifier(spark: SparkSession, base: str) -> DataFrame:
    return quality_scores(_read(spark, base, "documents"), _read(spark, base, "labels"))


def op3_secret_scan(spark: SparkSession, base: str) -> DataFrame:
    return digest(secret_scan(_read(spark, base, "documents")))


def op4_benchmark_decontamination(spark: SparkSession, base: str) -> DataFrame:
    found = find_contamination(_read(spark, base, "documents"), _read(spark, base, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def op5_token_counts(spark: SparkSession, base: str) -> DataFrame:
    return token_counts(_read(spark, base, "documents"))


def op6_suffix_array_dedup(spark: SparkSession, base: str) -> DataFrame:
    done = suffix_dedup(_read(spark, base, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", _sha256("kept").alias("kept_sha256"))


def op7_exact_top_k(spark: SparkSession, base: str) -> DataFrame:
    vectors = _read(spark, base, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op8_substring_dedup(spark: SparkSession, base: str) -> DataFrame:
    done = substring_dedup(_read(spark, base, "documents"))
    return done.select("doc_id", "n_words", "n_removed", _sha256("kept").alias("kept_sha256"), "n_spans")


def op9_best_fit_packing(spark: SparkSession, base: str) -> DataFrame:
    return pack(_read(spark, base, "documents"))


def op10_line_dedup(spark: SparkSession, base: str) -> DataFrame:
    done = line_dedup(_read(spark, base, "documents"), every=True)
    return done.select("doc_id", "n_lines", "n_removed", "n_blocks", _sha256("kept").alias("kept_sha256"))


def op11_minhash_near_dedup(spark: SparkSession, base: str) -> DataFrame:
    return minhash_dedup(_read(spark, base, "documents"))


def op12_phrase_mining(spark: SparkSession, base: str) -> DataFrame:
    return phrase_mining(_read(spark, base, "documents"))


def op13_ranked_lexical_search(spark: SparkSession, base: str) -> DataFrame:
    return lexical_search(_read(spark, base, "documents"), _read(spark, base, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_secret_scan": op3_secret_scan,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_token_counts": op5_token_counts,
    "op6_suffix_array_dedup": op6_suffix_array_dedup,
    "op7_exact_top_k": op7_exact_top_k,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_line_dedup": op10_line_dedup,
    "op11_minhash_near_dedup": op11_minhash_near_dedup,
    "op12_phrase_mining": op12_phrase_mining,
    "op13_ranked_lexical_search": op13_ranked_lexical_search,
}
