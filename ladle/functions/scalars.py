"""Conversions between source-system encodings and Spark types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: offset that makes 1900-01-01 the serial 36525 in the day-serial date dialect.
DAY_SERIAL_OFFSET = 36525


def date_to_day_serial(date: Column) -> Column:
    return F.datediff(date, F.lit("1900-01-01").cast("date")) + F.lit(DAY_SERIAL_OFFSET)


def day_serial_to_date(serial: Column) -> Column:
    return F.date_add(F.lit("1900-01-01").cast("date"), serial.cast("int") - F.lit(DAY_SERIAL_OFFSET))


def implied_decimal(units: Column, scale: int = 2) -> Column:
    return (units / F.lit(10**scale)).cast(f"decimal(18,{scale})")


def epoch_ms_to_timestamp(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def ts_text(ts: Column) -> Column:
    """Second-precision text of a timestamp."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
