"""Plant telemetry: topic filters, routing, payload parsing, windows. Batch and streaming alike."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.operators.rollup import Measure, Rollup

# Payload schema of plant telemetry, and of execution-system events.
TELEMETRY_SCHEMA = ("deviceID string, tagName string, value double, timestamp bigint, quality string, "
                    "metadata map<string,string>")
MES_SCHEMA = "work_order_id string, event string, product string, ts bigint"

# Topic filter to table, first match wins (the root level is ours).
TOPIC_MAP = [
    ("plant/+/meltshop/#", "bronze.ot.furnace_telemetry"),
    ("plant/+/caster/#", "bronze.ot.caster_history"),
    ("plant/+/rollmill/mes/#", "bronze.mes.rollmill_orders"),
    ("plant/#", "bronze.ot.unmapped_topics"),
]

# Expectations on parsed telemetry.
TELEMETRY_RULES = {"valid_ts": "ts IS NOT NULL", "good_quality": "quality IN ('GOOD','UNCERTAIN')"}

# Fixed value: system code inside the telemetry hash key.
TELEMETRY_SYSTEM = "LITMUS"


def topic_regex(topic_filter: str, parent: bool = False) -> str:
    """Anchored regex of a topic filter: ``+`` is one level, ``#`` the rest.

    With ``parent`` a trailing ``/#`` also matches its parent level, as brokers define it.
    """
    out = []
    for part in re.split(r"([+#])", topic_filter):
        out.append({"+": "[^/]+", "#": ".*"}.get(part, re.escape(part)))
    regex = "".join(out)
    if parent and topic_filter.endswith("/#"):
        regex = regex[: -len("/.*")] + "(/.*)?"
    return f"^{regex}$"


def route(topic: Column, topic_map: list[tuple[str, str]] = TOPIC_MAP) -> Column:
    """Target table of a topic; NULL where nothing matches."""
    out = F.when(topic.rlike(topic_regex(topic_map[0][0])), topic_map[0][1])
    for pattern, target in topic_map[1:]:
        out = out.when(topic.rlike(topic_regex(pattern)), target)
    return out


def routed(records: DataFrame) -> DataFrame:
    return records.withColumn("target_table", route(F.col("topic")))


def _level(i: int) -> Column:
    return F.get(F.split("topic", "/"), F.lit(i))


def parse_telemetry(records: DataFrame) -> DataFrame:
    """Broker records to (site, area, asset, tag, ts, value, quality, _raw, _source_system)."""
    parsed = records.withColumn("p", F.from_json(F.col("value").cast("string"), TELEMETRY_SCHEMA))
    return parsed.select(
        _level(1).alias("site"), _level(2).alias("area"), _level(3).alias("asset"), F.col("p.tagName").alias("tag"),
        F.timestamp_millis("p.timestamp").alias("ts"), F.col("p.value").alias("value"),
        F.col("p.quality").alias("quality"), F.to_json("p").alias("_raw"),
        F.lit(TELEMETRY_SYSTEM).alias("_source_system"), F.col("timestamp").alias("_ingest_ts"))


def parse_mes(records: DataFrame) -> DataFrame:
    """Execution-system events have their own payload, keyed by work order."""
    parsed = records.withColumn("p", F.from_json(F.col("value").cast("string"), MES_SCHEMA))
    return parsed.select(
        _level(1).alias("site"), _level(2).alias("area"), F.col("p.work_order_id").alias("work_order_id"),
        F.col("p.event").alias("event"), F.col("p.product").alias("product"), F.timestamp_millis("p.ts").alias("ts"),
        F.col("value").cast("string").alias("payload"), F.col("timestamp").alias("_ingest_ts"))


def unmapped(records: DataFrame) -> DataFrame:
    return records.select("topic", F.col("timestamp").alias("ts"), F.col("value").cast("string").alias("_raw"))


#: Readings of a sensor in windows of five minutes.
SENSOR_WINDOWS = Rollup(
    time="ts", width="5 minutes", fields=("site", "asset", "tag"), system=TELEMETRY_SYSTEM,
    measures=(Measure("samples", "count"), Measure("max_value", "max", "value"), Measure("avg_value", "avg", "value")))


def alerts(telemetry: DataFrame, limits: DataFrame) -> DataFrame:
    """Readings above the limit of their tag; stateless, so it also runs on a stream.

    ``limits`` is a small rule table (tag, limit_value) of known size.
    """
    return telemetry.join(limits, "tag").filter(F.col("value") > F.col("limit_value"))
