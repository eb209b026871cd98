"""Version history: latest row per key, no-op suppression, validity intervals, survivorship."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladle.functions.keys import content_hash, hash_key
from ladle.operators.ordered import previous_value


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row of every key in ``order``.

    ``rn = 1`` right above the window lets Spark cut each key to one row per map task before the
    shuffle, so a key that holds a third of the table costs no more to move than any other.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rank).filter("_rn = 1").drop("_rn")


def silver_envelope(df: DataFrame, pk: list[str], effective_ts: Column, business: list[str]) -> DataFrame:
    """Add hk, record_hash and effective_ts. The time is an argument, so reruns give equal rows."""
    return df.withColumns({
        "hk": hash_key("source_system", *pk),
        "record_hash": content_hash(business),
        "effective_ts": effective_ts,
    })


def current_rows(df: DataFrame, seq: str | None = None) -> DataFrame:
    """Current version per hk; equal times are settled by sequence, then by content."""
    order = [F.col("effective_ts").desc()]
    if seq:
        order.append(F.col(seq).desc())
    return latest_per_key(df, ["hk"], [*order, F.col("record_hash")])


def drop_noops(df: DataFrame, order: list[str]) -> DataFrame:
    """Leave out a version whose content equals that of the version before it."""
    seen = previous_value(df, "hk", [F.col(c) for c in order], "record_hash")
    return seen.filter(~F.col("_previous").eqNullSafe(F.col("record_hash"))).drop("_previous")


def validity_intervals(df: DataFrame, order: list[str]) -> DataFrame:
    """valid_from / valid_to / is_current derived from the insert-only log."""
    following = previous_value(df, "hk", [F.col(c).desc() for c in order], "effective_ts")
    return following.withColumnsRenamed({"effective_ts": "valid_from", "_previous": "valid_to"}).withColumn(
        "is_current", F.col("valid_to").isNull())


def survivor(df: DataFrame, match_key: list[str], priority: list[str], columns: list[str],
             recency: list[str]) -> DataFrame:
    """Best source wins, column by column: the first non-NULL value in priority order, newest first.

    Plain aggregates, so every map task folds a match group to one row before the shuffle.
    """
    rank = F.lit(0)
    for i, system in enumerate(priority):
        rank = F.when(F.col("source_system") == system, F.lit(len(priority) - i)).otherwise(rank)
    best = df.withColumn("_order", F.struct(rank.alias("rank"), *recency))
    return best.groupBy(*match_key).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_order"))).alias(c) for c in columns],
        F.count("*").alias("contributors"))
