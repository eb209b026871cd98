"""Batch and streaming reads of the given parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ladle.session import configure


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of one table, whether it is a single file or a folder of part files."""
    reader = configure(spark).readStream.schema(table(spark, sf_dir, name).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # A glob, because the file source takes a plain path to be a folder.
    return reader.parquet(f"{sf_dir}/{name}.parquet*")
