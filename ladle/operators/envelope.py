"""The Bronze envelope every landed record carries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_envelope(df: DataFrame, system: str, batch_id: str, ingest_ts: Column,
                  op: str | None = None, seq: str | None = None) -> DataFrame:
    """Add _source_system, _ingest_ts, _batch_id, _op_type, _seq and the raw source row as JSON."""
    return df.withColumns({
        "_source_system": F.lit(system),
        "_ingest_ts": ingest_ts,
        "_batch_id": F.lit(batch_id),
        "_op_type": F.col(op) if op else F.lit("I"),
        "_seq": F.col(seq).cast("long") if seq else F.lit(None).cast("long"),
        "_raw": F.to_json(F.struct(*df.columns)),
    })


def soft_delete_flag(df: DataFrame, op: str = "_op_type") -> DataFrame:
    return df.withColumn("is_deleted", F.coalesce(F.col(op) == "D", F.lit(False)))
