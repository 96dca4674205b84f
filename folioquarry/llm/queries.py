"""The queries of the training-data operators; each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents
from .op01_language import language_rows
from .op02_jaccard import jaccard_components
from .op03_secrets import secret_rows
from .op04_simhash import edited_fingerprints
from .op05_sentencepiece import piece_rows
from .op06_mixing import mix_plan
from .op07_licenses import scan_licenses
from .op08_sharding import assign_shards
from .op09_quality import quality_rows
from .op10_line_dedup import dedup_lines
from .op11_clustering import clustered_rows
from .op12_conversations import repaired_rows
from .op13_minhash import near_duplicates


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_rows(documents(spark, sf_dir))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir), words=3, percent=90)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_rows(documents(spark, sf_dir))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(documents(spark, sf_dir))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_rows(documents(spark, sf_dir))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix_plan(documents(spark, sf_dir))
    return plan.selectExpr("doc_id", "size", "source_size", "target", "size * times AS taken")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(documents(spark, sf_dir).select("doc_id"), "doc_id")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rows(documents(spark, sf_dir))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the lines deleted, and the digest of the text that is left."""
    cleaned = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return cleaned.select("doc_id", "removed_lines", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered_rows(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired_rows(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), words=4, percent=80)


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_jaccard_join, op3_secret_scan, op4_simhash, op5_sentencepiece,
    op6_mixing, op7_license_scan, op8_sharding, op9_quality_rules, op10_line_dedup,
    op11_centroid_clustering, op12_conversation_repair, op13_minhash_dedup,
)}
