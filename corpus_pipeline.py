"""From documents to packed training sequences: good, unique, uncontaminated, without secrets.

Each stage takes what its predecessor kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stationday.llm import decontamination, neardup, packing, quality, secrets
from stationday.llm.common import stage, table


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, a similarity of 0.8)."""
    return neardup.keep_first(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets taken out of their texts."""
    return secrets.redact(docs, secrets.train(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids in sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", good),
    ("near duplicates", unique),
    ("benchmark decontamination", uncontaminated),
    ("secret scans", redacted),
    ("packing", packed),
]

#: A trained classifier, a trained index and byte-pair encoding have no SQL form; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
