"""Sequential change detection: the first run at which a series left its baseline, by a robust CUSUM in window functions.

A series (a score of one table and dimension, a row count of one table) is measured in robust units: the distance from the median
of its first ``baseline`` runs, over their scaled median absolute deviation, or ``floor`` of the median where that is larger.
A distance counts as ``CLIP`` units at most, so one odd run raises no alarm. What exceeds ``slack`` adds up; the sum starts over
whenever it falls to zero; above ``alarm`` the series has changed. The change began with the first run after the sum was last zero,
so a slow drift is dated back to where it set in.

The sum is the running total less the smallest running total so far, which two window functions give. Units are whole millionths,
so sums are exact. Windows run over audit rows, one per series and run. NULL values are left out; a series of no values has no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

UNIT, CLIP = 1_000_000, 4


def change_points(series: DataFrame, keys: list[str], run: str, value: str, baseline: int = 12, slack: float = 0.5,
                  alarm: float = 5.0, floor: float = 0.01) -> DataFrame:
    """keys, direction, first_bad, alarmed_at, last_bad, runs, peak: one row per change, downward and upward.

    ``run`` orders the runs of a series and is unique in it. ``peak`` is the largest sum, in robust units.
    """
    in_order = Window.partitionBy(*keys).orderBy(run)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    seen = series.select(*keys, run, F.col(value).cast("double").alias("x")).filter("x IS NOT NULL").withColumn("n", F.row_number().over(in_order))
    whole = Window.partitionBy(*keys)
    early = F.col("n") <= baseline
    seen = seen.withColumn("centre", F.median(F.when(early, F.col("x"))).over(whole))
    seen = seen.withColumn("spread", F.median(F.when(early, F.abs(F.col("x") - F.col("centre")))).over(whole))
    scale = F.greatest(F.col("spread") * 1.4826, F.abs("centre") * floor, F.lit(1e-9))
    z = F.greatest(F.least((F.col("x") - F.col("centre")) / scale, F.lit(float(CLIP))), F.lit(-float(CLIP)))
    units = seen.withColumn("z", F.round(z * UNIT).cast("long"))
    signed = units.select(*keys, run, F.inline(F.array(
        F.struct(F.lit("down").alias("direction"), (-F.col("z") - int(slack * UNIT)).alias("step")),
        F.struct(F.lit("up").alias("direction"), (F.col("z") - int(slack * UNIT)).alias("step")))))
    both = [*keys, "direction"]
    so_far = Window.partitionBy(*both).orderBy(run).rowsBetween(Window.unboundedPreceding, 0)
    summed = signed.withColumn("total", F.sum("step").over(so_far))
    summed = summed.withColumn("s", F.col("total") - F.least(F.lit(0), F.min("total").over(so_far)))
    summed = summed.withColumn("stretch", F.count_if(F.col("s") == 0).over(so_far))
    return summed.filter("s > 0").groupBy(*both, "stretch").agg(
        F.min(run).alias("first_bad"), F.min(F.when(F.col("s") > int(alarm * UNIT), F.col(run))).alias("alarmed_at"),
        F.max(run).alias("last_bad"), F.count("*").alias("runs"), (F.max("s") / UNIT).alias("peak")).filter("alarmed_at IS NOT NULL").drop("stretch")
