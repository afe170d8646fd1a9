"""The registered queries of the corpus operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import alignment_digests
from .cotraining import quality_scores
from .decontam import contained_items
from .html_blocks import extract_main_text
from .katz_lm import katz_scores
from .language_id import fit_languages, predict_languages
from .line_quality import quality_rules
from .merkle import manifest_digests
from .mixing import mixed
from .secrets import scan_secrets
from .sharding import sharded
from .simhash import simhash_components
from .sql import OP3_LINE_QUALITY, OP6_DECONTAMINATION, OP13_MERKLE
from .token_counts import token_counts


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the public 50k vocabulary."""
    return token_counts(table(spark, sf_dir, "documents"))


def op2_katz_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Katz scores of every document; learned from those whose id's CRC-32 modulo 7 isn't 2."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    found = katz_scores(docs, ~held_out, F.col("doc_id")).scores
    return found.select(F.col("row").alias("doc_id"), (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document; its source is its host."""
    return quality_rules(table(spark, sf_dir, "documents"))


def op4_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by the co-trained views."""
    found = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumnRenamed("id", "doc_id")


def op5_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_main_text(table(spark, sf_dir, "pages"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document contains, with its containment."""
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return scan_secrets(table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document, by nearly equal bytes."""
    return sharded(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, probability and draw of every document under flattened source, language and topic shares."""
    return mixed(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of both public vocabularies in every document."""
    return alignment_digests(table(spark, sf_dir, "documents"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from those whose id's CRC-32 modulo 3 isn't 1."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1
    found = predict_languages(docs, fit_languages(docs, ~held_out))
    return found.withColumn("held_out", held_out).select("doc_id", "held_out", "lang_pred", "score", "runner_up", "ambiguous")


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and verification of every document in the manifest of all languages."""
    return manifest_digests(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_counts": op1_token_counts,
        "op2_katz_lm": op2_katz_lm,
        "op3_line_quality": op3_line_quality,
        "op4_cotraining": op4_cotraining,
        "op5_html_blocks": op5_html_blocks,
        "op6_decontamination": op6_decontamination,
        "op7_secrets": op7_secrets,
        "op8_sharding": op8_sharding,
        "op9_mixing": op9_mixing,
        "op10_simhash": op10_simhash,
        "op11_alignment": op11_alignment,
        "op12_language_id": op12_language_id,
        "op13_merkle": op13_merkle,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_line_quality": OP3_LINE_QUALITY, "op6_decontamination": OP6_DECONTAMINATION, "op13_merkle": OP13_MERKLE}
