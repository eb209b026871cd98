"""Writes: materialize, append with a commit log, clustered layout, registry inserts, typed DDL."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Control and audit tables.
TABLES = {
    "cfg.source_registry":
        "source_name STRING, system STRING, region STRING, pattern STRING, target_table STRING, "
        "primary_key ARRAY<STRING>, sequence_col STRING, schedule STRING, expectations MAP<STRING,STRING>, "
        "registered_by STRING, registered_at TIMESTAMP, active BOOLEAN",
    "cfg.layer_mappings":
        "mapping_id STRING, layer STRING, src_table STRING, src_column STRING, tgt_table STRING, tgt_column STRING, "
        "transform_expr STRING, dq_rule STRING, version INT, valid_from TIMESTAMP, valid_to TIMESTAMP, changed_by STRING",
    "cfg.pipeline_registry":
        "pipeline_id STRING, pipeline_name STRING, source_name STRING, created_at TIMESTAMP, active BOOLEAN",
    "audit.rejected_records":
        "reject_id STRING, batch_id STRING, source_name STRING, target_table STRING, layer STRING, failed_rule STRING, "
        "dq_dimension STRING, record_payload STRING, rejected_at TIMESTAMP",
    "audit.batch_log":
        "batch_id STRING, source_name STRING, layer STRING, rows_read BIGINT, rows_written BIGINT, "
        "rows_rejected BIGINT, started_at TIMESTAMP, finished_at TIMESTAMP, status STRING, error STRING",
    "audit.dq_results":
        "batch_id STRING, table_name STRING, dimension STRING, rule STRING, total BIGINT, passed BIGINT, score DOUBLE, "
        "met_threshold BOOLEAN, run_at TIMESTAMP",
}


def create_tables(spark: SparkSession) -> None:
    """Create the control and audit tables where they are absent."""
    for name, ddl in TABLES.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet")


def append(df: DataFrame, name: str) -> None:
    """Append to a catalog table, columns matched by name and cast to the table's types."""
    schema = df.sparkSession.table(name).schema
    df.select(*[F.col(f.name).cast(f.dataType) for f in schema]).write.mode("append").insertInto(name)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Replace a batch-defined table and return it as read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def publish_view(df: DataFrame, name: str) -> None:
    """Publish a frame as a view of the session; policies applied below it stay in force."""
    df.createOrReplaceTempView(name)


def write_clustered(df: DataFrame, path: str, keys: list[str], files: int | None = None) -> DataFrame:
    """Range-partition and sort by ``keys``, so that min/max statistics prune row groups on read.

    A hot key value spreads over several ranges when a further key tells its rows apart. The
    number of files follows the session's shuffle partitions unless given.
    """
    ranged = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


class VersionedTable:
    """Append-only table in a folder: one sub-folder per batch, and a commit log next to it.

    Writing a batch twice replaces its folder, so a retried batch never doubles rows.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def append(self, df: DataFrame, batch_id: str) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/data/batch={batch_id}")
        entry = self.spark.createDataFrame([(batch_id,)], "batch_id string")
        entry.withColumn("committed_at", F.current_timestamp()).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/commits/entry={batch_id}")

    def read(self) -> DataFrame:
        """Rows of committed batches; a batch whose commit was never written does not exist."""
        rows = self.spark.read.option("mergeSchema", "true").parquet(f"{self.path}/data")
        done = self.history().select(F.col("batch_id").alias("_done")).distinct()
        return rows.join(done, F.col("batch").cast("string") == F.col("_done"), "left_semi")

    def history(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/commits").drop("entry")

    def exists(self) -> bool:
        try:
            self.spark.read.parquet(f"{self.path}/commits")
            return True
        except AnalysisException:
            return False
