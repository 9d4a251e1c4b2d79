"""A training corpus in five stages, each one of the operators of ``bursa.llm``.

Each stage works on all that its predecessor kept, and its result is written as Parquet
and read again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bursa.llm import bpe_codec, decontaminate, pii, quality_knn, simhash
from bursa.llm.common import scratch, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest-neighbour classifier rejects go; texts without words are judged too."""
    return quality_knn.accepted(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the document with the smallest id stays (null ids last); all
    texts without words are one component."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go; null and empty texts hold none."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are masked; every document stays, null texts stay null."""
    return pii.mask(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of ids and of the decoded bytes; a null or
    empty text has no ids. Repeated rows give repeated rows, an empty table none."""
    return bpe_codec.round_trip(docs)


STAGES = [("quality classifier", quality), ("simhash near-dedup", near_dedup),
          ("benchmark decontamination", decontamination), ("pii", personal_data), ("byte-level bpe", byte_bpe)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), scratch(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{k}")
        docs = spark.read.parquet(f"{path}/{k}")
    return docs


# The first stage's learned scores are not expressible in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None
