"""The queries opN_<name>: thin, over whole tables, with the digest columns of their contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm import bpe, exact_dedup, filter_audit, line_dedup, lm_score, media, packing, quality, secret_scan, simhash, substring_dedup, suffix_dedup, vector_codes
from tidewire.llm.common import documents


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = exact_dedup.exact_duplicates(documents(spark, sf_dir))
    return got.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = suffix_dedup.deduplicate_bytes(documents(spark, sf_dir))
    return got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("content", 256).alias("kept_sha256"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = substring_dedup.deduplicate_windows(documents(spark, sf_dir))
    return got.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = secret_scan.scan_documents(documents(spark, sf_dir))
    return got.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.simhash_groups(documents(spark, sf_dir))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = bpe.encode_documents(documents(spark, sf_dir))
    return got.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = media.image_copies(media.page_images(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    return got.select(F.col("id").alias("page_id"), "n_features", "component_id")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = line_dedup.deduplicate_lines(documents(spark, sf_dir))
    return got.select("doc_id", F.col("lines_before").alias("n_lines"), F.col("lines_dropped").alias("n_dropped"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = vector_codes.compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return got.select(F.col("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256")


def op12_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(documents(spark, sf_dir))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {q.__name__: q for q in (op1_exact_dedup, op2_suffix_dedup, op3_quality, op4_substring_dedup, op5_secret_scans, op6_packing, op7_simhash, op8_byte_bpe, op9_media, op10_line_dedup, op11_vector_codes, op12_lm_score, op13_filter_audit)}
