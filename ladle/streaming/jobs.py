"""Structured Streaming jobs. All progress lives in the checkpoint below the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ladle.operators import telemetry
from ladle.operators.cdc import net_changes
from ladle.operators.expectations import all_hold, failed_rules, failure_counts
from ladle.operators.rollup import Rollup
from ladle.sinks import VersionedTable

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Keep state off the heap: the key space of a mirror outgrows executor memory."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def append_parquet(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append-mode file sink: exactly once, through the sink's own commit log."""
    return (df.writeStream.format("parquet").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())


def run_append(df: DataFrame, base: str, trigger: dict | None = None) -> DataFrame:
    """Run an append job over what is available and return the table it wrote."""
    query = append_parquet(df, f"{base}/table", f"{base}/checkpoint", trigger)
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{base}/table")


def with_counted_drops(df: DataFrame, rules: dict[str, str], name: str) -> DataFrame:
    """Drop failing rows of a stream; counts per rule appear in every progress report."""
    kept = all_hold(rules)
    counted = df.observe(name, F.count(F.lit(1)).alias("rows_read"), F.count_if(kept).alias("rows_kept"),
                         *failure_counts(rules))
    return counted.filter(kept)


def ingest_telemetry(records: DataFrame, source: dict) -> DataFrame:
    """Parse the topics of one registered source, with its watermark and its expectations."""
    mine = records.filter(F.col("topic").rlike(telemetry.topic_regex(source["topic_filter"])))
    parsed = telemetry.parse_telemetry(mine).withWatermark("ts", source.get("watermark", "10 minutes"))
    return with_counted_drops(parsed, source["expectations"], source["name"])


def run_counted(stream: DataFrame, drop: dict[str, str], warn: dict[str, str], by: dict[str, Column], at: str, base: str,
                trigger: dict | None = None) -> DataFrame:
    """Run an append job that stores rows and progress of every micro-batch, and return the progress table.

    Rows go to ``rows/batch=n/kept=true`` or, if a rule of ``drop`` failed, to ``kept=false`` with the names of the failed rules; rules of
    ``warn`` only count. Progress has a row per batch and value of ``by``: rows_read, rows_kept, the counts of failed rules and the last ``at``. Both
    are written under the number of the batch, so a batch that is run again replaces what it wrote, and nothing is lost however
    many batches there are. Counters are taken from the rows as written, once, on the executors.
    """
    rules = {**drop, **warn}

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        flagged = batch.withColumns({**by, "failed_rules": failed_rules(rules), "kept": all_hold(drop)})
        flagged.write.mode("overwrite").partitionBy("kept").parquet(f"{base}/rows/batch={number}")
        rows = spark.read.schema(flagged.schema).parquet(f"{base}/rows/batch={number}")
        counts = [F.struct(F.lit(r).alias("name"), F.count_if(F.array_contains("failed_rules", r)).alias("failed")) for r in rules]
        progress = rows.groupBy(*by).agg(F.count("*").alias("rows_read"), F.count_if("kept").alias("rows_kept"), F.max(at).alias("last_at"), F.array(*counts).alias("failed"))
        progress.coalesce(1).write.mode("overwrite").parquet(f"{base}/progress/batch={number}")

    query = (stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{base}/checkpoint")
             .trigger(**(trigger or {"availableNow": True})).start())
    query.awaitTermination()
    return stream.sparkSession.read.parquet(f"{base}/progress")


def run_windows(stream: DataFrame, rollup: Rollup, late_after: str, base: str, trigger: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Roll a stream up into windows and keep apart the rows that come too late for theirs: (windows, late rows).

    A window is emitted once, when a time ``late_after`` beyond its end has been seen; a row whose window was emitted in an earlier
    micro-batch, or that has no time, goes to ``late`` unchanged. What is kept of open windows are mergeable parts, folded on the
    map side, so a series that holds most rows does not meet in one task and no Python runs; the table of parts has two slots
    that batches use in turn. Everything is written under the number of its batch: a batch that fails and is run again reads the
    slot and the mark of the batch before it and replaces what it wrote.
    """
    spark = stream.sparkSession
    nothing = spark.createDataFrame([], stream.schema)
    kept, done = rollup.cells(nothing).schema, rollup.finish(rollup.cells(nothing)).schema
    spark.createDataFrame([], done).write.mode("overwrite").parquet(f"{base}/windows/_of=-1")
    nothing.write.mode("overwrite").parquet(f"{base}/late/_of=-1")

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = spark.read.schema("mark long").parquet(f"{base}/marks/of={number - 1}").first()["mark"] if number else None
        ended = F.col("_span.end") <= F.timestamp_micros(F.lit(before).cast("long"))
        batch = batch.persist()
        try:
            placed = batch.withColumn("_span", F.window(rollup.time, rollup.width))
            late = placed.filter(ended).drop("_span").unionByName(batch.filter(F.col(rollup.time).isNull()))
            late.write.mode("overwrite").parquet(f"{base}/late/_of={number}")
            cells = rollup.cells(placed.filter(~F.coalesce(ended, F.lit(False))).drop("_span"))
            if number:
                still = spark.read.schema(kept).parquet(f"{base}/open/slot={(number - 1) % 2}").filter(~F.coalesce(ended, F.lit(False)))
                cells = rollup.merge(still.select(cells.columns).unionByName(cells))
            cells.write.mode("overwrite").parquet(f"{base}/open/slot={number % 2}")
        finally:
            batch.unpersist()
        cells = spark.read.schema(kept).parquet(f"{base}/open/slot={number % 2}")
        mark = F.greatest(F.unix_micros(F.max("_last") - F.expr(f"INTERVAL '{late_after}'")), F.lit(before).cast("long"))
        cells.agg(mark.alias("mark")).write.mode("overwrite").parquet(f"{base}/marks/of={number}")
        now = spark.read.schema("mark long").parquet(f"{base}/marks/of={number}").first()["mark"]
        closed = cells.filter(F.col("_span.end") <= F.timestamp_micros(F.lit(now).cast("long")))
        rollup.finish(closed).write.mode("overwrite").parquet(f"{base}/windows/_of={number}")

    query = (stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{base}/checkpoint")
             .trigger(**(trigger or {"availableNow": True})).start())
    query.awaitTermination()
    return tuple(spark.read.schema(schema).option("basePath", f"{base}/{name}").parquet(f"{base}/{name}/*").drop("_of")
                 for name, schema in (("windows", done), ("late", stream.schema)))


def progress_events(progress: DataFrame, pipeline: Column, run: Column, flow: Column) -> DataFrame:
    """Stored progress as event rows (pipeline_id, event_type, timestamp, origin, details); batches of one run and flow add up."""
    named = progress.select(pipeline.alias("pipeline_id"), run.alias("run"), flow.alias("flow"), "rows_read", "rows_kept", "last_at", F.inline("failed"))
    rules = named.groupBy("pipeline_id", "run", "flow", "name").agg(
        F.sum("failed").alias("failed"), F.sum("rows_read").alias("read"), F.sum("rows_kept").alias("kept"), F.max("last_at").alias("last_at"))
    counter = F.struct("name", F.concat(F.lit("bronze."), F.col("flow")).alias("dataset"), (F.col("read") - F.col("failed")).alias("passed_records"),
                       F.col("failed").alias("failed_records"))
    runs = rules.groupBy("pipeline_id", "run", "flow").agg(
        F.max("read").alias("read"), F.max("kept").alias("kept"), F.max("last_at").alias("last_at"), F.array_sort(F.collect_list(counter)).alias("counters"))
    details = F.to_json(F.struct(F.struct(
        F.lit("COMPLETED").alias("status"), F.struct(F.col("kept").alias("num_output_rows")).alias("metrics"),
        F.struct((F.col("read") - F.col("kept")).alias("dropped_records"), F.col("counters").alias("expectations")).alias("data_quality")).alias("flow_progress")))
    return runs.select("pipeline_id", F.lit("flow_progress").alias("event_type"), F.col("last_at").alias("timestamp"),
                       F.struct(F.col("run").alias("update_id"), F.col("flow").alias("flow_name")).alias("origin"), details.alias("details"))


def mirror_changes(changes: DataFrame, keys: list[str], seq: str, base: str,
                   trigger: dict | None = None) -> StreamingQuery:
    """Stateful change apply: each micro-batch appends the new net change of the keys it touched.

    State holds one row per key, tombstones included, so a late lower sequence can never revive
    or overwrite a key. Only touched keys are written; the whole mirror is never rewritten.
    """
    use_rocksdb(changes.sparkSession)
    latest = net_changes(changes, keys, seq)
    log = VersionedTable(changes.sparkSession, f"{base}/log")

    def write(batch: DataFrame, batch_id: int) -> None:
        log.append(batch, str(batch_id))

    return (latest.writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", f"{base}/checkpoint").trigger(**(trigger or {"availableNow": True})).start())


def read_mirror(spark: SparkSession, keys: list[str], seq: str, base: str, op: str = "op_type") -> DataFrame:
    """Current mirror from the appended net changes."""
    log = VersionedTable(spark, f"{base}/log").read().drop("batch")
    return net_changes(log, keys, seq).filter(~F.col(op).eqNullSafe(F.lit("D"))).drop(op)
