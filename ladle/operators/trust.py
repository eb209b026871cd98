"""Dashboards over the audit tables: scores over time, scorecards, freshness, trust."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.operators.versions import latest_per_key


def mean_score() -> Column:
    """Average score in decimal arithmetic: scores have five digits, so rounding the mean is exact."""
    return F.avg(F.col("score").cast("decimal(10,5)"))


def heatmap(results: DataFrame) -> DataFrame:
    return results.groupBy(F.col("run_at").cast("date").alias("day"), "dimension", "table_name").agg(
        F.round(mean_score(), 4).cast("double").alias("avg_score"), F.min("met_threshold").alias("all_passed"))


def latest_results(results: DataFrame) -> DataFrame:
    return latest_per_key(results, ["table_name", "dimension"], [F.col("run_at").desc(), F.col("batch_id").desc()])


def scorecard(results: DataFrame) -> DataFrame:
    breached = F.when(~F.col("met_threshold"), F.col("dimension"))
    return latest_results(results).groupBy("table_name").agg(
        F.round(mean_score() * 100, 2).cast("double").alias("trust_score_pct"),
        F.count_if(~F.col("met_threshold")).alias("breached_dimensions"),
        F.array_sort(F.collect_list(breached)).alias("breaches"))


def rejects_drilldown(rejects: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    recent = rejects.filter(F.col("rejected_at") > as_of - F.expr(f"INTERVAL '{days}' DAY"))
    return recent.groupBy(F.date_trunc("hour", "rejected_at").alias("hour"), "target_table", "dq_dimension",
                          "failed_rule").agg(F.count("*").alias("rejected_rows"))


def batch_health(log: DataFrame) -> DataFrame:
    read = F.sum("rows_read")
    return log.groupBy(F.col("finished_at").cast("date").alias("day"), "source_name").agg(
        F.sum("rows_written").alias("rows_written"), F.sum("rows_rejected").alias("rows_rejected"),
        F.round(F.sum("rows_rejected") / F.nullif(read, F.lit(0)) * 100, 3).alias("reject_pct"))


def freshness(log: DataFrame, product_flows: DataFrame, products: DataFrame, as_of: Column) -> DataFrame:
    """Minutes since the last load of a product's inputs against its target; never loaded is NULL."""
    last = log.groupBy("source_name").agg(F.max("finished_at").alias("last_load"))
    per_product = (product_flows.join(last, "source_name", "left").groupBy("product")
                   .agg(F.min("last_load").alias("last_load"), F.count_if(F.col("last_load").isNull()).alias("missing")))
    loaded = F.when(F.col("missing") == 0, F.col("last_load"))
    minutes = F.timestamp_diff("MINUTE", F.col("last_load"), as_of)
    return (products.join(per_product, "product", "left").withColumn("last_load", loaded)
            .withColumn("minutes_since_load", minutes)
            .withColumn("fresh", F.coalesce(F.col("minutes_since_load") <= F.col("sla_minutes"), F.lit(False)))
            .select("product", "last_load", "minutes_since_load", "sla_minutes", "fresh"))


def trust_band(score: Column) -> Column:
    # Bands of the trust score.
    return F.when(score >= 98, "GREEN").when(score >= 95, "AMBER").otherwise("RED")


def trust_scores(results: DataFrame, product_tables: DataFrame, fresh: DataFrame) -> DataFrame:
    """0.7 * quality + 0.3 * (100 when fresh else 50), per product."""
    quality = latest_results(results).join(product_tables, "table_name").groupBy("product").agg(
        (F.avg("score") * 100).alias("dq"))
    score = F.col("dq") * 0.7 + F.when(F.col("fresh"), 100.0).otherwise(50.0) * 0.3
    return quality.join(fresh, "product", "left").select(
        "product", F.round("dq", 4).alias("dq_score_pct"), F.coalesce("fresh", F.lit(False)).alias("fresh"),
        F.round(score, 4).alias("trust_score"), trust_band(score).alias("band"))


def contract_check(results: DataFrame, product_tables: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Worst latest score of a product's tables per dimension against the product's contract."""
    measured = latest_results(results).join(product_tables, "table_name").groupBy("product", "dimension").agg(
        F.min("score").alias("score"))
    return thresholds.join(measured, ["product", "dimension"], "left").withColumn(
        "met", F.coalesce(F.col("score") >= F.col("threshold"), F.lit(False)))
