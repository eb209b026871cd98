"""Incremental file ingest with a schema that is inferred once and then kept."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMATS = {"json", "parquet", "csv", "orc", "avro"}


def persisted_schema(spark: SparkSession, landing: str, fmt: str, schema_dir: str, **options: str) -> T.StructType:
    """Schema of a landing folder: read from ``schema_dir``, or inferred and stored there."""
    try:
        text = spark.read.text(schema_dir).first()
        if text is not None:
            return T.StructType.fromJson(json.loads(text[0]))
    except AnalysisException:
        pass
    schema = spark.read.format(fmt).options(**options).load(landing).schema
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(schema_dir)
    return schema


def incremental(spark: SparkSession, landing: str, fmt: str, schema_dir: str, files_per_trigger: int | None = None,
                **options: str) -> DataFrame:
    """Streaming scan of a landing folder; the checkpoint of the sink remembers which files are done."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}")
    if fmt == "csv":
        options = {"header": "true", "inferSchema": "true", **options}
    schema = persisted_schema(spark, landing, fmt, schema_dir, **options)
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(landing)


def topic_stream(spark: SparkSession, servers: str, topic_filter: str, **options: str) -> DataFrame:
    """Broker source subscribed by the regex of a topic filter (needs the Kafka connector jar)."""
    from ladle.operators.telemetry import topic_regex

    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
           .option("subscribePattern", topic_regex(topic_filter)).options(**options).load())
    return raw.select("topic", F.col("value").cast("string").alias("value"), "timestamp")
