"""Lineage, blast radius, drift and root cause over mapping edges and audit tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ladle import session, sinks
from ladle.sources import seeds


def read_columns(frame: DataFrame, expression: str) -> list[str]:
    """The columns that a SQL expression over ``frame`` reads, taken from the analysed expression and not from its text.

    Names of functions, literals and lambda variables are never taken for columns. A name that the frame does not have is returned
    too: the source has lost it. It joins the frame as an untyped column, and the analysis is repeated. Nothing is executed.
    """
    lost: list[str] = []
    while True:
        try:
            read = frame.selectExpr(expression)._jdf.queryExecution().analyzed().references().toSeq()
            own = {c.lower(): c for c in frame.columns}
            return [own.get(name.lower(), name) for name in (read.apply(i).name() for i in range(read.size()))]
        except AnalysisException as problem:
            if not (problem.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
                raise
            name = problem.getMessageParameters()["objectName"].strip("`").split("`.`")[0]
            if name in lost:
                raise
            lost.append(name)
            frame = frame.withColumn(name, F.lit(None))


EDGE = "src_table string; src_column string; tgt_table string; tgt_column string"


def column_edges(spark: SparkSession, expressions: list[tuple[str, str, str, str]], sources: dict[str, DataFrame]) -> DataFrame:
    """Column-level edges of ``(src_table, tgt_table, tgt_column, expression)``: one for each column that an expression reads.

    The list is configuration: it is as long as there are target columns. A plain name needs no analysis, nor does its table.
    """
    rows = []
    for source, target, column, expression in expressions:
        plain = expression.isidentifier() and (source not in sources or expression in sources[source].columns)
        rows += [(source, read, target, column) for read in ([expression] if plain else read_columns(sources[source], expression))]
    return seeds.inline(spark, rows, EDGE)


def _reached(hops: DataFrame, start: DataFrame) -> DataFrame:
    """(node, depth) of all that ``hops`` (origin, node) lead to from ``start`` (node), with the shortest distance, however deep.

    Breadth first: every node enters the frontier once, so neither cycles nor the number of paths matter. Rounds are
    tables in the shared folder.
    """
    spark = hops.sparkSession
    hops = sinks.materialize(hops.distinct(), session.shared_dir(spark, "hops"))
    reached, frontier, depth = None, start, 0
    while True:
        depth += 1
        step = hops.join(frontier.withColumnRenamed("node", "origin"), "origin").select("node").distinct()
        fresh = step if reached is None else step.join(reached, "node", "left_anti")
        found = sinks.materialize(fresh.withColumn("depth", F.lit(depth)), session.shared_dir(spark, "reach"))
        reached = found if reached is None else reached.unionByName(found)
        if not found.limit(1).count():
            return reached
        frontier = found.select("node")


def downstream(edges: DataFrame, start: str) -> DataFrame:
    """Tables that depend on ``start``, with the shortest distance."""
    hops = edges.select(F.col("src_table").alias("origin"), F.col("tgt_table").alias("node"))
    return _reached(hops, edges.sparkSession.createDataFrame([(start,)], "node string")).withColumnRenamed("node", "table_name")


def column_impact(edges: DataFrame, table: str, column: str) -> DataFrame:
    """Columns that depend on one column, through expressions too: (table_name, column_name, depth)."""
    def named(t: str, c: str) -> Column:
        return F.struct(F.col(t).alias("table_name"), F.col(c).alias("column_name"))

    hops = edges.select(named("src_table", "src_column").alias("origin"), named("tgt_table", "tgt_column").alias("node"))
    start = edges.sparkSession.createDataFrame([((table, column),)], "node struct<table_name string, column_name string>")
    return _reached(hops, start).select("node.*", "depth")


def column_profile(df: DataFrame, table: str) -> DataFrame:
    """(table_name, column_name, data_type, rows, non_null) for all columns, from one aggregate."""
    totals = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(f"_c_{c}") for c in df.columns])
    entries = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("data_type"), F.col(f"_c_{c}").alias("non_null"))
        for c, t in df.dtypes])
    return totals.select(F.lit(table).alias("table_name"), F.inline(entries), F.col("_rows").alias("rows"))


def schema_drift(profile: DataFrame, mappings: DataFrame) -> DataFrame:
    """Source columns no mapping reads, and mapped columns the source no longer has.

    ``mappings`` lists (src_table, src_column) actually referenced, expressions included.
    """
    have = profile.select(F.col("table_name").alias("src_table"), F.col("column_name").alias("src_column"), "non_null")
    used = mappings.select("src_table", "src_column").filter("src_column IS NOT NULL").distinct()
    unmapped = have.join(used, ["src_table", "src_column"], "left_anti").withColumn("drift", F.lit("unmapped"))
    gone = used.join(have, ["src_table", "src_column"], "left_anti").select(
        "src_table", "src_column", F.lit(None).cast("long").alias("non_null"), F.lit("missing").alias("drift"))
    return unmapped.unionByName(gone)


def schema_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Added, dropped and retyped columns between two column lists; dropping or retyping breaks readers."""
    old = before.select("table_name", "column_name", F.col("data_type").alias("old_type"))
    new = after.select("table_name", "column_name", F.col("data_type").alias("new_type"), "non_null")
    change = (F.when(F.col("old_type").isNull(), "added").when(F.col("new_type").isNull(), "dropped")
              .when(F.col("old_type") != F.col("new_type"), "type_changed"))
    return (old.join(new, ["table_name", "column_name"], "full_outer").withColumn("change", change)
            .filter("change IS NOT NULL").withColumn("breaking", F.col("change") != "added"))


def root_cause(results: DataFrame, volumes: DataFrame, spike: float = 1.5) -> DataFrame:
    """Breached results next to the last green run, the first bad one of the streak, and volume spikes.

    Windows run over audit rows: one per (table, dimension, run).
    """
    w = Window.partitionBy("table_name", "dimension").orderBy("run_at", "batch_id")
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    green_id: Column = F.when(F.col("met_threshold"), F.col("batch_id"))
    green_score: Column = F.when(F.col("met_threshold"), F.col("score"))
    seen = results.withColumns({
        "last_green_batch": F.last(green_id, ignorenulls=True).over(past),
        "last_green_score": F.last(green_score, ignorenulls=True).over(past),
        "streak": F.count_if("met_threshold").over(w.rowsBetween(Window.unboundedPreceding, 0)),
    })
    streak = Window.partitionBy("table_name", "dimension", "streak")
    bad = (seen.filter(~F.col("met_threshold"))
           .withColumn("first_bad_batch", F.min("batch_id").over(streak)))
    vw = Window.partitionBy("table_name").orderBy("batch_id")
    ratio = volumes.withColumn("prev_rows", F.lag("rows").over(vw)).select(
        "table_name", "batch_id", "rows", F.coalesce(F.col("rows") > F.col("prev_rows") * F.lit(spike), F.lit(False)).alias("volume_spike"))
    return bad.join(ratio, ["table_name", "batch_id"], "left").select(
        "table_name", "dimension", "batch_id", "score", "last_green_batch", "last_green_score", "first_bad_batch",
        F.round(F.col("score") - F.col("last_green_score"), 5).alias("score_drop"), "rows", "volume_spike")
