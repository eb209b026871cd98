"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Let capped rankings cut rows on the map side up to the largest cap in use.
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that results or skew handling rely on, once per session.

    Cluster sizing is left alone, and so is whatever the caller changes afterwards.
    """
    if spark.conf.get("ladle.configured", None) is None:
        for key, value in ENGINE_CONF.items():
            spark.conf.set(key, value)
        spark.conf.set("ladle.configured", "true")
    return spark


def build(master: str | None = None, app: str = "ladle", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**ENGINE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_base: dict[str, str] = {}


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to the machine's temporary folder: executors on
    other hosts could not read it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = _local_base.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="ladle-")
        _local_base[spark.sparkContext.applicationId] = base
    return f"{base.rstrip('/')}/ladle/{name}-{uuid.uuid4().hex}"
