"""Catalog metadata as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def tables(spark: SparkSession, database: str) -> DataFrame:
    rows = [(database, t.name, t.tableType, t.description) for t in spark.catalog.listTables(database)
            if not t.isTemporary]
    return spark.createDataFrame(rows, "table_schema string, table_name string, table_type string, comment string")


def columns(spark: SparkSession, database: str) -> DataFrame:
    rows = [(database, t.name, c.name, c.dataType, c.nullable)
            for t in spark.catalog.listTables(database) if not t.isTemporary
            for c in spark.catalog.listColumns(f"{database}.{t.name}")]
    return spark.createDataFrame(
        rows, "table_schema string, table_name string, column_name string, data_type string, nullable boolean")
