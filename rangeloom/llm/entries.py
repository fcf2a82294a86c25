"""The queries of this package, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rangeloom.llm import bpe, classifier, line_dedup, media, oracle, packing, pii, quality_rules, resampling, simhash, spelling, suffix_dedup, token_count, token_store
from rangeloom.llm.common import importable, read_table


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"), length=200)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), words=4, distance=4)


def op3_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_columns(read_table(spark, sf_dir, "documents"))


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store(read_table(spark, sf_dir, "documents"), end_id=0)


def op5_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.checked(read_table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, sf_dir, "documents"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_and_decode(read_table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), capacity=1024)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(read_table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resampling.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_spellings(read_table(spark, sf_dir, "documents"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_lines(read_table(spark, sf_dir, "documents"), least_chars=40, least_docs=5)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


QUERIES = (op1_suffix_array_dedup, op2_simhash_near_dedup, op3_media_columns, op4_token_store, op5_pii_surrogates, op6_quality_rules, op7_byte_bpe, op8_quality_classifier, op9_best_fit_packing, op10_token_counts, op11_importance_resampling, op12_spelling_variants, op13_line_dedup)


def _ready(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable(spark)
        return f(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: _ready(f) for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    """The others are not SQL; tests/llm compares each with brute force, an exact round trip or held-out labels."""
    return dict(oracle.SQL)
