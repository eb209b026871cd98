"""Run logs: progress events to batch log and rule-level rejects, for all flows in one query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.operators.quality import dimension_of

# Shape of the expectation counters inside a progress event.
EXPECTATION_SCHEMA = "array<struct<name:string,dataset:string,passed_records:bigint,failed_records:bigint>>"
_PROGRESS = "$.flow_progress"


def _detail(path: str) -> Column:
    return F.get_json_object("details", f"{_PROGRESS}.{path}")


def active_events(events: DataFrame, registry: DataFrame) -> DataFrame:
    """Progress events of registered, active flows: one join instead of a loop over flows."""
    active = registry.filter("active").select("pipeline_id")
    return events.filter("event_type = 'flow_progress'").join(active, "pipeline_id", "left_semi")


def batch_log(events: DataFrame) -> DataFrame:
    measured = events.filter(_detail("metrics").isNotNull())
    written = _detail("metrics.num_output_rows").cast("long")
    rejected = _detail("data_quality.dropped_records").cast("long")
    return measured.select(
        F.col("origin.update_id").alias("batch_id"), F.col("origin.flow_name").alias("source_name"),
        F.lit("bronze").alias("layer"), (written + F.coalesce(rejected, F.lit(0))).alias("rows_read"),
        written.alias("rows_written"), rejected.alias("rows_rejected"), F.col("timestamp").alias("started_at"),
        F.col("timestamp").alias("finished_at"), _detail("status").alias("status"),
        F.lit(None).cast("string").alias("error"))


def rule_rejects(events: DataFrame) -> DataFrame:
    """One row per rule that dropped rows, with its quality dimension."""
    counters = F.from_json(_detail("data_quality.expectations"), EXPECTATION_SCHEMA)
    return (
        events.select(F.col("origin.update_id").alias("batch_id"), F.col("origin.flow_name").alias("source_name"),
                      F.col("timestamp").alias("rejected_at"), F.explode_outer(counters).alias("e"))
        .filter("e.failed_records > 0")
        .select(
            F.sha2(F.concat_ws("|", "batch_id", "source_name", "e.name"), 256).alias("reject_id"), "batch_id",
            "source_name", F.col("e.dataset").alias("target_table"), F.lit("bronze").alias("layer"),
            F.col("e.name").alias("failed_rule"), dimension_of(F.col("e.name")).alias("dq_dimension"),
            F.to_json(F.struct(F.col("e.failed_records").alias("failed_records"))).alias("record_payload"),
            "rejected_at")
    )
