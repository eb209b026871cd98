"""Customer features, their versions, and point-in-time joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.operators.ordered import previous_value
from ladle.operators.versions import latest_per_key

WINDOWS = (7, 30, 90, 365)


def customer_features(fact: DataFrame, as_of: str) -> DataFrame:
    """Lifetime value, order counts and recency per customer, as known at ``as_of``.

    Folded per (customer, order) first: that settles both distinct counts without expanding the
    rows, and spreads a hot customer by its orders.
    """
    day = F.lit(as_of).cast("date")
    known = fact.filter((F.col("order_date") < day) & F.col("customer_hk").isNotNull())
    per_order = known.groupBy("customer_hk", "order_hk").agg(
        F.sum("order_amount_usd").alias("amount"), F.max("order_date").alias("last"))
    return per_order.groupBy("customer_hk").agg(
        F.sum("amount").alias("ltv_usd"),
        F.count("*").alias("order_count_all"),
        F.count_if(F.col("last") >= F.date_sub(day, 365)).alias("order_count_365d"),
        F.max("last").alias("last_order_date"),
    ).withColumns({
        "days_since_last_order": F.datediff(day, F.col("last_order_date")),
        "feature_ts": day.cast("timestamp_ntz"),
    })


def windowed_features(fact: DataFrame, as_of: str) -> DataFrame:
    """Revenue of the last 7 / 30 / 90 / 365 days, 90-day order count and an RFM-style risk score.

    Strictly before ``as_of``. The score is ours: recency share of a year, lowered by frequency.
    """
    day = F.lit(as_of).cast("date")
    known = fact.filter((F.col("order_date") < day) & F.col("customer_hk").isNotNull())

    def within(n: int) -> Column:
        return F.col("order_date") >= F.date_sub(day, n)

    zero = F.lit(0).cast("decimal(20,4)")
    out = known.groupBy("customer_hk").agg(
        *[F.sum(F.when(within(n), F.col("order_amount_usd")).otherwise(zero)).alias(f"rev_l{n}d_usd") for n in WINDOWS],
        F.count_if(within(90)).alias("order_count_l90"),
        F.datediff(day, F.max("order_date")).alias("days_since_last_order"))
    recency = F.least(F.col("days_since_last_order") / F.lit(365.0), F.lit(1.0))
    frequency = F.lit(1.0) / (F.lit(1.0) + F.col("order_count_l90"))
    return out.withColumn("churn_risk_score", F.round(recency * 0.6 + frequency * 0.4, 4))


def asof_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
              payload: list[str]) -> DataFrame:
    """Latest ``right`` row with right_ts <= left_ts for every left row; NULLs where there is none.

    Both sides are stacked and swept once in time order, features first at equal times, so no
    pairs are built and a hot key is cut into ranges like any other.
    """
    facts = left.select(F.col(key).alias("_k"), F.col(left_ts).cast("timestamp_ntz").alias("_t"), F.lit(1).alias("_side"),
                        F.struct(*left.columns).alias("_row"))
    known = right.select(F.col(key).alias("_k"), F.col(right_ts).cast("timestamp_ntz").alias("_t"),
                         F.lit(0).alias("_side"),
                         F.struct(F.col(right_ts).alias("_matched_ts"), *payload).alias("_val"))
    stacked = facts.unionByName(known, allowMissingColumns=True)
    swept = previous_value(stacked, "_k", [F.col("_t"), F.col("_side")], "_val").filter("_side = 1")
    return swept.select("_row.*", F.col("_previous._matched_ts").alias("matched_ts"),
                        *[F.col(f"_previous.{p}") for p in payload])


def online_snapshot(features: DataFrame, key: str = "customer_hk", ts: str = "feature_ts") -> DataFrame:
    """Latest version per key, for point lookups."""
    return latest_per_key(features, [key], [F.col(ts).desc()])


def merge_versions(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Feature table after a merge on (key, ts): incoming rows replace rows with the same keys."""
    return existing.join(incoming.select(*keys), keys, "left_anti").unionByName(incoming)


def absent_rows(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Insert-if-absent: the incoming rows whose key the target does not hold yet."""
    return incoming.join(target.select(*keys), keys, "left_anti")
