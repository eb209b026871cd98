"""Inline expectations: drop, warn, split, and row-level quarantine, each in one pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

Rules = dict[str, str]


def holds(rule: str) -> Column:
    """A rule holds only when TRUE; NULL is a failure, so total = passed + failed."""
    return F.coalesce(F.expr(rule), F.lit(False))


def all_hold(rules: Rules) -> Column:
    return reduce(lambda a, b: a & b, [holds(r) for r in rules.values()], F.lit(True))


def failure_counts(rules: Rules) -> list[Column]:
    return [F.count_if(~holds(r)).alias(name) for name, r in rules.items()]


def drop_failing(df: DataFrame, rules: Rules, observation: Observation | None = None) -> DataFrame:
    """Keep rows for which all rules hold. Counts per rule ride along in the same job."""
    if not rules:
        return df
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("rows_read"), *failure_counts(rules))
    return df.filter(all_hold(rules))


def failed_rules(rules: Rules) -> Column:
    return F.array_compact(F.array(*[F.when(~holds(r), F.lit(name)) for name, r in rules.items()]))


def flag(df: DataFrame, rules: Rules) -> DataFrame:
    """Keep failed-rule names and the share of rules that hold as columns of the record."""
    failed = failed_rules(rules)
    return df.withColumn("failed_rules", failed).withColumn(
        "dq_score", F.lit(1.0) - F.size("failed_rules") / F.lit(float(len(rules))))


def split(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine); quarantine rows carry the names of the rules they failed."""
    flagged = df.withColumn("failed_rules", failed_rules(rules))
    return (flagged.filter(F.size("failed_rules") == 0).drop("failed_rules"),
            flagged.filter(F.size("failed_rules") > 0))


def violation_counts(df: DataFrame, rules: Rules) -> DataFrame:
    """(rule, total, failed) for all rules of a frame from one aggregate."""
    totals = df.agg(F.count(F.lit(1)).alias("_total"), *[
        F.count_if(~holds(r)).alias(f"_f{i}") for i, r in enumerate(rules.values())])
    pairs = ", ".join(f"'{name}', _f{i}" for i, name in enumerate(rules))
    return totals.selectExpr("_total AS total", f"stack({len(rules)}, {pairs}) AS (rule, failed)").select(
        "rule", "total", "failed")


def cap_per_group(df: DataFrame, group: list[str], order: list[str], cap: int, salts: int = 1024) -> DataFrame:
    """The first ``cap`` rows of every group in ``order``, exactly, merged in two steps.

    A map task's rows share a salt, so the limit already cuts them to ``cap`` per group before the
    first shuffle (up to the session's window-group-limit threshold); of a group that holds most
    of the table, only ``cap * salts`` rows meet in one task.
    """
    ranked = df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    for part in ([*group, "_salt"], group):
        rank = F.row_number().over(Window.partitionBy(*part).orderBy(*order))
        ranked = ranked.withColumn("_rn", rank).filter(F.col("_rn") <= cap).drop("_rn")
    return ranked.drop("_salt")
