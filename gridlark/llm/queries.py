"""The operators' queries over the synthetic tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridlark.llm import ann, decontam, jaccard, license_scan, mixture, pii, quality, secret_scan, token_count, toxicity
from gridlark.llm.common import crc_remainder, table


def op1_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score_toxicity(docs, labels, learn=crc_remainder("doc_id", 5) != 0)
    return scored.select("doc_id", (crc_remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return token_count.count_tokens(table(spark, sf_dir, "documents"), f.read())


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality.score_quality(docs, labels, learn=crc_remainder("doc_id", 4) != 2)
    return scored.select("doc_id", (crc_remainder("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


_QUERIES = (op1_mixture, op2_toxicity, op3_token_counts, op4_decontamination, op5_pii, op6_neighbours, op7_secrets, op8_near_duplicates, op9_licenses, op10_quality)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op1_mixture": mixture.SQL, "op4_decontamination": decontam.SQL, "op8_near_duplicates": jaccard.SQL, "op9_licenses": license_scan.sql()}
