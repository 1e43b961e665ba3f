"""A pipeline over documents: toxicity, near duplicates, benchmark contamination, secrets, mixture.

Each stage takes what the one before it kept, as Parquet read again, and returns the columns of documents; the mixture,
the last, adds its own. Repeated rows, nulls and empty texts pass as the operators' docstrings say.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlark.llm import decontam, jaccard, mixture, secret_scan, toxicity
from gridlark.llm.common import checkpoint_folder, crc_remainder, forget, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learnt from the labels of these documents, does not predict toxic."""
    scored = toxicity.score_toxicity(docs, table(spark, sf_dir, "labels"), learn=crc_remainder("doc_id", 5) != 0, carry=docs.columns, prefix="toxicity_")
    return scored.filter("toxicity_predicted = 0").select(*[F.col(f"`{c}`") for c in docs.columns])


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of Jaccard similarity 0.8 on five-word shingles hold together, the one of least id."""
    return jaccard.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of ten words of the benchmark occurs."""
    found = decontam.contamination(docs, table(spark, sf_dir, "benchmark"), carry=docs.columns, prefix="benchmark_")
    return found.filter("NOT benchmark_contaminated").select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a credential that looks live: random, with one or two owners and in few documents over the corpus."""
    return secret_scan.rows_without_live(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mixture takes, with how many of their words it takes."""
    return mixture.mixed_rows(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", one_of_near_duplicates),
    ("benchmark contamination", drop_contaminated),
    ("secrets", drop_secrets),
    ("mixture", mix_sources),
]

#: Model scores and MinHash are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that all stages leave. A stage's rows are deleted when the next stage's are written; the last one's stay."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            forget(spark, f"{folder}/{k - 1}")
    return docs
