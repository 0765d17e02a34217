"""The registered queries of this subpackage, with their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import (
    byte_bpe,
    decontaminate,
    divergence,
    language_id,
    line_dedup,
    lm_scoring,
    packing,
    phrases,
    quality,
    simhash,
    substring_dedup,
    token_files,
    topk,
)
from .common import read_table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(read_table(spark, sf_dir, "documents"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lm_scoring.score(read_table(spark, sf_dir, "documents"))
    return found.withColumns({"log_score": F.round("log_score", 3), "mean_log_score": F.round("mean_log_score", 5)})


def op2_lm_scoring_order3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lm_scoring.score(read_table(spark, sf_dir, "documents"), order=3)
    return found.withColumns({"log_score": F.round("log_score", 3), "mean_log_score": F.round("mean_log_score", 5)})


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_report(read_table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(read_table(spark, sf_dir, "documents"))


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.whole_vectors(read_table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, F.pmod("vec_id", F.lit(50)) == 0, k=5)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return decontaminate.report(decontaminate.contamination(docs, items))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_all(spark, sf_dir)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return marked.select("doc_id", simhash.fingerprint_hex().alias("fingerprint"), "component_id")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(read_table(spark, sf_dir, "documents"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = byte_bpe.decode(byte_bpe.encode(read_table(spark, sf_dir, "documents")))
    decimals = F.array_join(F.col("ids").cast("array<string>"), " ")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimals, 256).alias("ids_sha256"),
                        F.sha2("data", 256).alias("decoded_sha256"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_substring_dedup, op2_lm_scoring, op2_lm_scoring_order3, op3_packing, op4_line_dedup,
                            op5_token_files, op6_exact_top_k, op7_decontamination, op8_quality, op9_language_id, op10_simhash,
                            op11_collocations, op12_byte_bpe, op13_divergence, pipeline)}

ORACLES: dict[str, str] = {
    "op2_lm_scoring": lm_scoring.REPORT_SQL,
    "op2_lm_scoring_order3": lm_scoring.REPORT_SQL_3,
    "op4_line_dedup": line_dedup.REPORT_SQL,
    "op6_exact_top_k": topk.REPORT_SQL,
    "op7_decontamination": decontaminate.REPORT_SQL,
    "op11_collocations": phrases.REPORT_SQL,
    "op13_divergence": divergence.REPORT_SQL,
}
