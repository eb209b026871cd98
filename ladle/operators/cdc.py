"""Change data capture without MERGE: latest change per key over an append-only log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.functions.keys import content_hash


def net_changes(changes: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The last change of every key, deletes included.

    ``max_by`` keeps one row per key on the map side and does not care about arrival order. The
    same aggregate runs over a stream.
    """
    rest = [c for c in changes.columns if c not in keys]
    return (changes.groupBy(*keys)
            .agg(F.max_by(F.struct(*rest), F.col(seq)).alias("_last"))
            .select(*keys, "_last.*"))


def scd1_mirror(changes: DataFrame, keys: list[str], seq: str, op: str = "op_type",
                drop: list[str] | None = None) -> DataFrame:
    """Current mirror of the source. A delete wins over every lower sequence, however late it comes."""
    return net_changes(changes, keys, seq).filter(~F.col(op).eqNullSafe(F.lit("D"))).drop(op, *(drop or []))


def snapshot_diff(before: DataFrame, after: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Insert / update / delete rows between two snapshots of one keyed table."""
    old = before.select(*keys, content_hash(columns).alias("_old"))
    new = after.select(*keys, *[c for c in columns if c not in keys], content_hash(columns).alias("_new"))
    change = (F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "delete")
              .when(F.col("_old") != F.col("_new"), "update"))
    return (old.join(new, keys, "full_outer").withColumn("change_type", change)
            .filter("change_type IS NOT NULL").drop("_old", "_new"))


def since_cursor(df: DataFrame, cursor: str, high_water: str | None) -> DataFrame:
    """Rows past the high-water mark; a plain comparison, so it reaches the scan."""
    if high_water is None:
        return df
    dtype = dict(df.dtypes)[cursor]
    return df.filter(F.col(cursor) > F.lit(high_water).cast(dtype))


def next_high_water(df: DataFrame, cursor: str) -> str | None:
    """The new mark: one aggregated value."""
    value = df.agg(F.max(cursor).cast("string")).first()[0]
    return value
