"""The corpus pipeline: quality, near duplicates, benchmark passages, personal data, packing.

Each stage works on all that the one before kept; stages are written as Parquet below the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ladle.llm import decontam, neardup, packing, pii, quality
from ladle.llm.common import free_name, read, stage


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8) stays."""
    return neardup.keep_one(docs, percent=80)


def decontam_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.clean(docs, read(spark, sf_dir, "benchmark"), share=0.8)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; the texts stay."""
    name = free_name(docs, "_cands")
    found = pii.with_candidates(docs, name)
    return pii.redact(found, pii.fit(found, name=name), name)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("quality", quality_stage), ("neardup", neardup_stage), ("decontam", decontam_stage), ("pii", pii_stage), ("packing", packing_stage)]
#: SQL cannot express the classifier, the labelers and the packing; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    name, function = STAGES[-1]
    return stage(function(spark, docs, sf_dir), name)
