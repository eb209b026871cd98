"""Source registry: one configuration row per source object."""

from __future__ import annotations

import datetime as dt
import re
from importlib import resources

import yaml
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Allowed ingestion patterns and regions.
PATTERNS = ["goldengate", "lakeflow_sqlserver", "lakeflow_query", "lakeflow_d365", "litmus_adls", "litmus_eventhub",
            "zerobus", "autoloader_file"]
REGIONS = ["EUROPE", "AMERICAS", "EMEA", "GLOBAL"]
CDC_PATTERNS = ["goldengate"]
TARGET_NAME = "^bronze\\.[a-z0-9_]+\\.[a-z0-9_]+$"

REGISTRY_SCHEMA = (
    "source_name string, system string, region string, pattern string, target_table string, primary_key array<string>, "
    "sequence_col string, schedule string, expectations map<string,string>, registered_by string, "
    "registered_at timestamp, active boolean"
)


def load(path: str | None = None) -> dict:
    text = open(path).read() if path else resources.files("ladle.config").joinpath("sources.yaml").read_text()
    return yaml.safe_load(text)


def source(name: str, config: dict | None = None) -> dict:
    """One source's settings with the file-wide defaults filled in."""
    config = config or load()
    for row in config["sources"]:
        if row["name"] == name:
            return {**config.get("defaults", {}), "expectations": {}, "schedule": "", **row}
    raise KeyError(f"source {name!r} is not registered")


def trigger(schedule: str, interval: str = "30 seconds") -> dict:
    """Continuous sources run on a processing-time trigger, scheduled ones take what is there and stop."""
    return {"processingTime": interval} if schedule == "continuous" else {"availableNow": True}


def registry_frame(spark: SparkSession, config: dict | None = None, user: str | None = None,
                   at: dt.datetime = dt.datetime(2001, 8, 1)) -> DataFrame:
    """Registry rows, typed - no SQL text is assembled, so rules may contain quotes.

    Registered by the session's user unless told otherwise.
    """
    rows = [
        (s["name"], s["system"], s["region"], s["pattern"], s["target"], s.get("primary_key", []),
         s.get("sequence_col", s.get("cursor_column", "")), s.get("schedule", ""), s.get("expectations", {}), user, at, True)
        for s in (config or load())["sources"]
    ]
    frame = spark.createDataFrame(rows, REGISTRY_SCHEMA)
    return frame.withColumn("registered_by", F.coalesce("registered_by", F.current_user()))


def validate(registry: DataFrame) -> DataFrame:
    """Onboarding checks per source, one boolean each."""
    checks = {
        "pattern_ok": F.col("pattern").isin(PATTERNS),
        "pk_ok": F.size("primary_key") > 0,
        "region_ok": F.col("region").isin(REGIONS),
        "target_ok": F.col("target_table").rlike(TARGET_NAME),
        "sequence_ok": ~F.col("pattern").isin(CDC_PATTERNS) | (F.col("sequence_col") != ""),
        "rules_ok": F.size("expectations") > 0,
    }
    out = registry.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in checks.items()})
    valid = F.lit(True)
    for k in checks:
        valid = valid & F.col(k)
    return out.withColumn("valid", valid)


def unparsable_rules(source_schema: DataFrame, expectations: dict[str, str]) -> list[str]:
    """Names of rules that do not analyse against a source's columns; nothing is executed."""
    bad = []
    for name, rule in expectations.items():
        try:
            source_schema.limit(0).filter(rule).schema
        except AnalysisException:
            bad.append(name)
    return bad


def table_name(target: str) -> str:
    """One naming rule for landed tables: ``bronze.<system>.<table>`` to ``<system>_<table>``."""
    return re.sub(r"[^a-z0-9]+", "_", target.split(".", 1)[1].lower())
