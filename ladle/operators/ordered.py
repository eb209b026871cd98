"""Scans along a key's ordered rows in two levels, in DataFrame operators only.

``Window.partitionBy(key)`` puts all rows of a key into one task; here one key may hold a third of the table. Instead:

1. Rows are range-partitioned by (key, order, tie-breaker). The tie-breaker is a hash of the row, so that a key that
   changed often at one instant is cut as well. A hot key takes as many ranges as its size asks for.
2. A window per (range, key) scans what lies inside a range; its groups are never larger than a range.
3. The swept rows are written once, so that all later steps see the same ranges, also after lost executors.
4. What crosses a border is one value per range: the state of the range's last key. A window over this frame, as long as
   the number of ranges, is joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladle.session import shared_dir

_RANGE, _TIE = "_scan_range", "_scan_tie"


def _written(df: DataFrame, name: str) -> DataFrame:
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _ranged(df: DataFrame, key: str, order: list[Column], cut_by: list[Column] | None) -> DataFrame:
    """Rows dealt to ranges of (key, order, tie); ``_scan_range`` numbers the ranges in order.

    Keys of range sampling reach the driver, so long order columns must be cut to a prefix by ``cut_by``.
    """
    tied = df.withColumn(_TIE, F.xxhash64(*df.columns))
    cut = order if cut_by is None else cut_by
    return tied.repartitionByRange(F.col(key), *cut, *([F.col(_TIE)] if cut_by is None else [])).withColumn(_RANGE, F.spark_partition_id())


def _borders(swept: DataFrame, key: str, state: Column) -> DataFrame:
    """One row per range: its last key and that key's state at the end of the range."""
    ends = swept.filter("_scan_end").select(_RANGE, F.struct(F.col(key).isNotNull().alias("some"), F.col(key).alias("key")).alias("at"), state.alias("state"))
    return ends.groupBy(_RANGE).agg(F.max("at").alias("at"), F.max_by(F.struct("state"), "at").alias("state")).select(
        _RANGE, F.col("at.key").alias("_last_key"), F.col("state.state").alias("_state"))


def previous_value(df: DataFrame, key: str, order: list[Column], value: str) -> DataFrame:
    """Add ``_previous``: the last non-NULL ``value`` before the row, in ``order``, of the same key.

    With descending ``order`` it is the next value. Rows equal in key and order are taken by a hash of the row; rows
    without a key have no previous value.
    """
    inside = Window.partitionBy(_RANGE, key).orderBy(*order, _TIE)
    swept = _written(_ranged(df, key, order, None).withColumns({
        "_previous": F.last(value, ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, -1)),
        "_scan_end": F.lead(F.lit(1)).over(inside).isNull()}), "scan")
    ends = _borders(swept, key, F.coalesce(value, "_previous"))
    known = ends.select(_RANGE, F.when(F.col("_state").isNotNull(), F.struct(F.col("_last_key").alias("key"), F.col("_state").alias("value"))).alias("end"))
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carry = known.select(_RANGE, F.last("end", ignorenulls=True).over(before).alias("_carry"))
    # A key that crosses a border is the last of every range it comes from, so the nearest known end settles it.
    found = F.coalesce("_previous", F.when(F.col("_carry.key") == F.col(key), F.col("_carry.value")))
    return (swept.join(F.broadcast(carry), _RANGE, "left").withColumn("_previous", F.when(F.col(key).isNotNull(), found))
            .select(*df.columns, "_previous"))


def row_numbers(df: DataFrame, key: str, order: list[Column], column: str, cut_by: list[Column] | None = None,
                keep: list[str] | None = None) -> DataFrame:
    """Add ``column``: the number, from 1, of the row among those of its key in ``order``. NULL is a key of its own.

    ``order`` must be total but for equal rows. ``cut_by`` are coarser columns of the same order for cutting ranges.
    Only the columns ``keep`` are returned (all, if None), so that long columns that only order rows are not written.
    """
    keep = df.columns if keep is None else keep
    inside = Window.partitionBy(_RANGE, key).orderBy(*order)
    swept = _written(_ranged(df, key, order, cut_by).withColumns({
        column: F.row_number().over(inside).cast("long"), "_scan_end": F.lead(F.lit(1)).over(inside).isNull()}).select(*keep, column, _RANGE, "_scan_end"), "scan")
    ends = _borders(swept, key, F.col(column))
    upto = ends.withColumn("_upto", F.sum("_state").over(Window.partitionBy("_last_key").orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, 0)))
    carry = upto.select(_RANGE, F.lag(F.struct("_last_key", "_upto")).over(Window.orderBy(_RANGE)).alias("_carry"))
    more = F.when(F.col("_carry").isNotNull() & F.col("_carry._last_key").eqNullSafe(F.col(key)), F.col("_carry._upto")).otherwise(F.lit(0))
    return swept.join(F.broadcast(carry), _RANGE, "left").withColumn(column, F.col(column) + more).select(*keep, column)
