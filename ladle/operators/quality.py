"""Six-dimension data-quality scoring, quarantine, gates, KPIs and remediation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.operators.expectations import cap_per_group, holds
from ladle.sources.seeds import DIMENSION_TOKENS

UNIQUE_RULE_TEXT = "distinct(hk,effective_ts)"
RuleRow = tuple[str, str, "str | None", float]


class QualityBreach(Exception):
    """Raised by the gate; lists the (table, dimension) pairs below threshold."""


def dimension_of(name: Column) -> Column:
    """DAMA dimension of an expectation name; the first matching token decides."""
    lowered = F.lower(name)
    out = F.when(lowered.contains(DIMENSION_TOKENS[0][0]), DIMENSION_TOKENS[0][1])
    for token, dimension in DIMENSION_TOKENS[1:]:
        out = out.when(lowered.contains(token), dimension)
    return out.otherwise("VALIDITY")


def _rule_scores(df: DataFrame, name: str, rules: list[RuleRow], by: list[str]) -> DataFrame:
    """Score every rule of one table per group of ``by``; rules may refer to ``run_at``.

    Rows fold to (group, hk, effective_ts) first - which settles uniqueness and combines on the
    map side - and then to one row per group, which is unpivoted to one row per rule.
    """
    mine = [r for r in rules if r[0] == name]
    passes = [(i, r[2]) for i, r in enumerate(mine) if r[2] is not None]
    counts = {"_total": F.count(F.lit(1)), **{f"_p{i}": F.count_if(holds(rule)) for i, rule in passes}}
    if len(passes) < len(mine):
        per_key = df.groupBy(*by, "hk", "effective_ts").agg(*[c.alias(n) for n, c in counts.items()])
        totals = per_key.groupBy(*by).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counts],
                                          F.count(F.lit(1)).alias("_distinct"))
    else:
        totals = df.groupBy(*by).agg(*[c.alias(n) for n, c in counts.items()])
    entries = F.array(*[
        F.struct(F.lit(dim).alias("dimension"), F.lit(rule or UNIQUE_RULE_TEXT).alias("rule"),
                 F.lit(threshold).cast("double").alias("threshold"),
                 F.col("_distinct" if rule is None else f"_p{i}").alias("passed"))
        for i, (_, dim, rule, threshold) in enumerate(mine)])
    score = F.when(F.col("total") > 0, F.col("passed") / F.col("total")).otherwise(F.lit(1.0))
    return totals.select(*by, F.col("_total").alias("total"), F.inline(entries)).withColumn("raw_score", score).select(
        *by, F.lit(name).alias("table_name"), "dimension", "rule", "total", "passed",
        F.round("raw_score", 5).alias("score"), (F.col("raw_score") >= F.col("threshold")).alias("met_threshold"))


RESULT_COLUMNS = ["batch_id", "table_name", "dimension", "rule", "total", "passed", "score", "met_threshold", "run_at"]


def score_table(df: DataFrame, name: str, rules: list[RuleRow], batch: Column, run_at: Column) -> DataFrame:
    """Scores per batch, for a table whose rows belong to many batches."""
    based = df.withColumns({"batch_id": batch, "run_at": run_at})
    return _rule_scores(based, name, rules, ["batch_id", "run_at"]).select(*RESULT_COLUMNS)


def score_run(df: DataFrame, name: str, rules: list[RuleRow], batch_id: str, run_at: Column) -> DataFrame:
    """One run over a whole table. The aggregate has no group, so an empty table yields its row: score 1.0."""
    scored = _rule_scores(df.withColumn("run_at", run_at), name, rules, [])
    return scored.withColumns({"batch_id": F.lit(batch_id), "run_at": run_at}).select(*RESULT_COLUMNS)


def score_tables(tables: dict[str, DataFrame], rules: list[RuleRow], batch: Column, run_at: Column) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b),
                  [score_table(df, name, rules, batch, run_at) for name, df in tables.items()])


def quarantine(df: DataFrame, name: str, rules: list[RuleRow], batch: Column, run_at: Column, row_key: list[str],
               rejected_at: Column | None = None, cap: int | None = None) -> DataFrame:
    """One reject row per failing (row, rule), all rules in one pass; uncapped unless asked."""
    mine = [r for r in rules if r[0] == name and r[2] is not None]
    based = df.withColumns({"batch_id": batch, "run_at": run_at})
    failing = F.array_compact(F.array(*[
        F.when(~holds(rule), F.struct(F.lit(rule).alias("failed_rule"), F.lit(dim).alias("dq_dimension")))
        for _, dim, rule, _ in mine]))
    when = rejected_at if rejected_at is not None else F.col("run_at")
    rows = based.withColumn("_key", F.concat_ws("|", *[F.col(c).cast("string") for c in row_key])).select(
        "batch_id", F.lit(name).alias("source_name"), F.lit(name).alias("target_table"),
        F.lit(name.split(".")[0]).alias("layer"), "_key", when.alias("rejected_at"),
        F.to_json(F.struct(*df.columns)).alias("record_payload"), F.explode(failing).alias("f"))
    out = rows.select(
        F.sha2(F.concat_ws("|", "batch_id", "f.failed_rule", "_key"), 256).alias("reject_id"), "batch_id",
        "source_name", "target_table", "layer", "f.failed_rule", "f.dq_dimension", "record_payload", "rejected_at")
    return cap_per_group(out, ["failed_rule"], ["reject_id", "record_payload"], cap) if cap else out


def gate(results: DataFrame) -> None:
    """Raise when any (table, dimension) misses its threshold, and name all that do. Reads scores, never rows."""
    low = results.filter(~F.col("met_threshold")).select("table_name", "dimension").distinct()
    breaches = [tuple(r) for r in low.orderBy("table_name", "dimension").collect()]
    if breaches:
        raise QualityBreach(f"below threshold: {breaches}")


def requeue(rejects: DataFrame, schema: str, defaults: dict[str, object], key: list[str]) -> DataFrame:
    """Rebuild rows from stored payloads, impute NULLs, and keep one row per key: the last rejected, ties to the larger payload."""
    newest = F.struct(*[c for c in ("rejected_at", "record_payload") if c in rejects.columns])
    parsed = rejects.select(F.from_json("record_payload", schema).alias("r"), newest.alias("_newest")).select("r.*", "_newest")
    row = F.struct(*[F.col(c) for c in parsed.columns if c not in ("_newest", *key)])
    kept = parsed.groupBy(*key).agg(F.max_by(row, "_newest").alias("_row"))
    return kept.select(*key, "_row.*").fillna(defaults)


def standardize(df: DataFrame, column: str, variants: DataFrame, out: str) -> DataFrame:
    """Canonical code of a variant, the raw code where no variant matches.

    ``variants`` is keyed by ``variant``; Catalyst picks the join from its real size.
    """
    lookup = variants.select(F.col("variant").alias(column), F.col("canonical").alias("_canonical"))
    return df.join(lookup, column, "left").withColumn(out, F.coalesce("_canonical", column)).drop("_canonical")


def reconcile(left: DataFrame, right: DataFrame, keys: list[str], a: str, b: str, tolerance: str) -> DataFrame:
    """Compare a source value with the authoritative one; absent on either side is a mismatch."""
    ok = F.abs(F.col(a) - F.col(b)) <= F.lit(tolerance).cast("decimal(18,6)")
    return left.join(right, keys, "full_outer").withColumn("matched", F.coalesce(ok, F.lit(False)))
