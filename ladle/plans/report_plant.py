"""Queries over plant telemetry, run logs, data quality, trust, vectors and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.functions.scalars import ts_text
from ladle.operators import changes, eventlog, expectations, fingerprints, lineage, policy, products, quality, telemetry, trust, vector_index, vectors
from ladle.operators.cdc import snapshot_diff
from ladle.operators.versions import current_rows
from ladle.plans import gold, report_sales, silver
from ladle.plans.oracle_parts import CHANGES, CUSTOMERS, GOLD, ORDERS, TELEMETRY, TS, with_parts
from ladle.plans.report_sales import _FEATURES, _NET, _features, num, staged, text_ts
from ladle.session import shared_dir
from ladle.sinks import VersionedTable
from ladle.sources import feeds, registry, seeds
from ladle.sources.tables import stream_table, table
from ladle.streaming import jobs

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return register


# ---------------------------------------------------------------- telemetry

def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.broker_records(table(spark, sf_dir, "events"))


def _furnace(records: DataFrame) -> DataFrame:
    mine = telemetry.routed(records).filter(F.col("target_table") == "bronze.ot.furnace_telemetry")
    return telemetry.parse_telemetry(mine)


@query("telemetry_parse", with_parts(TELEMETRY, """
SELECT site, 'meltshop' AS area, asset_id AS asset, tag, strftime(ms, '%Y-%m-%d %H:%M:%S.%g') AS ts, value, quality,
       'LITMUS' AS _source_system FROM fur"""))
def telemetry_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _furnace(_records(spark, sf_dir)).select(
        "site", "area", "asset", "tag", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("ts"), "value", "quality",
        "_source_system")


@query("topic_route", with_parts(TELEMETRY, """
SELECT topic, CASE WHEN regexp_matches(topic, '^plant/[^/]+/meltshop/.*$') THEN 'bronze.ot.furnace_telemetry'
                   WHEN regexp_matches(topic, '^plant/[^/]+/caster/.*$') THEN 'bronze.ot.caster_history'
                   WHEN regexp_matches(topic, '^plant/[^/]+/rollmill/mes/.*$') THEN 'bronze.mes.rollmill_orders'
                   WHEN regexp_matches(topic, '^plant/.*$') THEN 'bronze.ot.unmapped_topics' END AS target_table,
       count(*) AS records FROM rec GROUP BY 1, 2"""))
def topic_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.routed(_records(spark, sf_dir)).groupBy("topic", "target_table").agg(F.count("*").alias("records"))


@query("mes_events", with_parts(TELEMETRY, """
SELECT site, 'rollmill' AS area, 'WO' || CAST(event_id + 80000 AS VARCHAR) AS work_order_id, mes_event AS event,
       'MAT-' || CAST(user_id % 6 AS VARCHAR) AS product, strftime(ms, '%Y-%m-%d %H:%M:%S.%g') AS ts
FROM rec WHERE event_type = 'purchase'"""))
def mes_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    mine = telemetry.routed(_records(spark, sf_dir)).filter(F.col("target_table") == "bronze.mes.rollmill_orders")
    return expectations.drop_failing(telemetry.parse_mes(mine), {"valid_pk": "work_order_id IS NOT NULL"}).select(
        "site", "area", "work_order_id", "event", "product", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("ts"))


@query("unmapped_topics", with_parts(TELEMETRY, """
SELECT topic, count(*) AS records FROM rec WHERE area_path = 'utilities' GROUP BY 1"""))
def unmapped_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catch-all table: no plant topic is silently lost."""
    rest = telemetry.routed(_records(spark, sf_dir)).filter(F.col("target_table") == "bronze.ot.unmapped_topics")
    return telemetry.unmapped(rest).groupBy("topic").agg(F.count("*").alias("records"))


def _good(records: DataFrame) -> DataFrame:
    return expectations.drop_failing(_furnace(records), telemetry.TELEMETRY_RULES)


def _heat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.SENSOR_WINDOWS.apply(_good(_records(spark, sf_dir)))


@query("furnace_heat_5min", with_parts(TELEMETRY, f"""
SELECT strftime(window_start, '{TS}') AS window_start, site, asset, tag, round(avg_value, 6) AS avg_value, max_value,
       samples, sha256(concat_ws('|', 'LITMUS', site, asset, tag, strftime(window_start, '{TS}'))) AS hk FROM heat"""))
def furnace_heat_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _heat(spark, sf_dir).select(text_ts("window_start"), "site", "asset", "tag",
                                       F.round("avg_value", 6).alias("avg_value"), "max_value", "samples", "hk")


@query("fact_heat_quality", with_parts(TELEMETRY, f"""
SELECT sha256(concat_ws('|', 'LITMUS', site, asset, tag, strftime(window_start, '{TS}'))) AS heat_hk, site, asset, tag,
       strftime(window_start, '{TS}') AS window_start, round(avg_value, 6) AS avg_value, max_value FROM heat"""))
def fact_heat_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.heat_quality(_heat(spark, sf_dir)).select(
        "heat_hk", "site", "asset", "tag", text_ts("window_start"), F.round("avg_value", 6).alias("avg_value"), "max_value")


LIMITS = [("temperature", 60.0), ("power_kw", 80.0)]


@query("telemetry_alerts", with_parts(TELEMETRY, """
SELECT site, asset_id AS asset, tag, strftime(ms, '%Y-%m-%d %H:%M:%S.%g') AS ts, value,
       CASE tag WHEN 'temperature' THEN 60.0::DOUBLE ELSE 80.0::DOUBLE END AS limit_value
FROM good WHERE value > CASE tag WHEN 'temperature' THEN 60.0 ELSE 80.0 END"""))
def telemetry_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = seeds.inline(spark, LIMITS, "tag string; limit_value double")
    return telemetry.alerts(_good(_records(spark, sf_dir)), limits).select(
        "site", "asset", "tag", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("ts"), "value", "limit_value")


# The plant data and the sales data of the given tables lie years apart; this lines their calendars up.
DAY_SHIFT = 1826


@query("product_melt_to_margin", with_parts(GOLD + "," + TELEMETRY, f"""
SELECT p.day, p.site, p.samples, p.peak_value, CAST(s.revenue AS DOUBLE) AS revenue_usd, s.orders
FROM (SELECT CAST(window_start AS DATE) AS day, site, CAST(sum(samples) AS BIGINT) AS samples, max(max_value) AS peak_value
      FROM heat GROUP BY 1, 2) p
LEFT JOIN (SELECT order_date + {DAY_SHIFT} AS day, sum(order_amount_usd) AS revenue, count(*) AS orders
           FROM fact GROUP BY 1) s ON s.day = p.day"""))
def product_melt_to_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = silver.orders_current(spark, sf_dir).withColumn("order_date", F.date_add("order_date", DAY_SHIFT))
    return products.melt_to_margin(_heat(spark, sf_dir), orders).withColumn("revenue_usd", num("revenue_usd"))


# ---------------------------------------------------------------- expectations and quality

SIL_RULES = silver.ORDER_RULES


@query("expect_drop", with_parts(ORDERS, """
SELECT hk, src_order_id, CAST(csn AS BIGINT) AS csn, CAST(order_amount_usd AS DOUBLE) AS order_amount_usd, currency_code
FROM sil"""))
def expect_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.sales_order_header(spark, sf_dir).select(
        "hk", "src_order_id", "csn", num("order_amount_usd"), "currency_code")


@query("expectation_counts", with_parts(ORDERS, """
SELECT r.rule, count(*) AS total, CAST(count(*) FILTER (CASE r.rule
    WHEN 'valid_hk' THEN hk IS NULL WHEN 'valid_amount' THEN (order_amount_usd >= 0) IS NOT TRUE
    ELSE currency_code IS NULL END) AS BIGINT) AS failed
FROM raw, (VALUES ('valid_hk'), ('valid_amount'), ('valid_currency')) r(rule) GROUP BY 1"""))
def expectation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expectations.violation_counts(silver.sales_order_header_raw(spark, sf_dir), SIL_RULES)


@query("quarantine_split", with_parts(ORDERS, """
SELECT src_order_id, CAST(csn AS BIGINT) AS csn, CASE WHEN hk IS NULL OR NOT coalesce(order_amount_usd >= 0, FALSE) OR currency_code IS NULL
       THEN 'quarantine' ELSE 'good' END AS side,
       concat_ws(',', CASE WHEN hk IS NULL THEN 'valid_hk' END,
                 CASE WHEN NOT coalesce(order_amount_usd >= 0, FALSE) THEN 'valid_amount' END,
                 CASE WHEN currency_code IS NULL THEN 'valid_currency' END) AS failed
FROM raw"""))
def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which side of the split every row falls on and why, in one pass over the rows."""
    flagged = expectations.flag(silver.sales_order_header_raw(spark, sf_dir), SIL_RULES)
    side = F.when(F.size("failed_rules") == 0, "good").otherwise("quarantine")
    return flagged.select("src_order_id", "csn", side.alias("side"), F.array_join("failed_rules", ",").alias("failed"))


@query("record_dq_score", with_parts(ORDERS, """
SELECT src_order_id, CAST(csn AS BIGINT) AS csn,
       round(1.0::DOUBLE - ((hk IS NULL)::INT + (NOT coalesce(order_amount_usd >= 0, FALSE))::INT + (currency_code IS NULL)::INT) / 3.0::DOUBLE, 6) AS dq_score,
       concat_ws(',', CASE WHEN hk IS NULL THEN 'valid_hk' END,
                 CASE WHEN NOT coalesce(order_amount_usd >= 0, FALSE) THEN 'valid_amount' END,
                 CASE WHEN currency_code IS NULL THEN 'valid_currency' END) AS failed
FROM raw"""))
def record_dq_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expectations.flag(silver.sales_order_header_raw(spark, sf_dir), SIL_RULES).select(
        "src_order_id", "csn", F.round("dq_score", 6).alias("dq_score"), F.array_join("failed_rules", ",").alias("failed"))


def _dq_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three scored tables, each with a ``dq_month`` that serves as its batch."""
    month = F.date_format("effective_ts", "yyyy-MM")
    raw = staged(silver.sales_order_header_raw(spark, sf_dir), "orders")
    customers = silver.customer(spark, sf_dir)
    current = silver.current_rows(expectations.drop_failing(raw, SIL_RULES), "csn")
    fact = gold.as_fact(current, gold.as_dimension(customers))
    return {
        "silver.sales_order_header": raw.withColumn("dq_month", month),
        "silver.customer": customers.withColumn("dq_month", month),
        "gold.fact_sales_orders": fact.withColumn("dq_month", F.date_format("order_date", "yyyy-MM")),
    }


def _month_end(month: Column) -> Column:
    """Runs take place at the start of the following month."""
    return F.add_months(F.to_date(month, "yyyy-MM"), 1).cast("timestamp_ntz")


def _dq_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit table of scores: one row per (table, dimension, month), stored as a run would store it."""
    scores = quality.score_tables(_dq_tables(spark, sf_dir), seeds.DQ_RULES, F.col("dq_month"), _month_end(F.col("dq_month")))
    return staged(scores, "dq_results")


def _dq_rows(batch: str, run_at: str, month: bool) -> str:
    group = "GROUP BY b, r" if month else ""

    def one(tbl: str, src: str, dim: str, rule: str, passed: str, thr: float, ts: str) -> str:
        b = f"strftime({ts}, '%Y-%m')" if month else f"'{batch}'"
        r = f"date_trunc('month', {ts}) + INTERVAL 1 MONTH" if month else f"TIMESTAMP '{run_at}'"
        return f"""
  SELECT b AS batch_id, '{tbl}' AS table_name, '{dim}' AS dimension, '{rule.replace("'", "''")}' AS rule, count(*) AS total,
         CAST({passed} AS BIGINT) AS passed, {thr}::DOUBLE AS thr, r AS run_at
  FROM (SELECT *, {b} AS b, {r} AS r FROM {src}) {group or 'GROUP BY b, r'}"""
    t = "effective_ts"
    return "dq0 AS (" + " UNION ALL ".join([
        one("silver.sales_order_header", "raw", "COMPLETENESS", "src_customer_id IS NOT NULL", "count(src_customer_id)", 0.99, t),
        one("silver.sales_order_header", "raw", "VALIDITY", "order_amount_usd BETWEEN 0 AND 50000000",
            "count(*) FILTER (order_amount_usd BETWEEN 0 AND 50000000)", 0.999, t),
        one("silver.sales_order_header", "raw", "UNIQUENESS", "distinct(hk,effective_ts)", "count(DISTINCT (hk, effective_ts))", 0.999, t),
        one("silver.sales_order_header", "raw", "TIMELINESS", "effective_ts >= run_at - INTERVAL 1 DAY",
            "count(*) FILTER (effective_ts >= r - INTERVAL 1 DAY)", 0.95, t),
        one("silver.customer", "cus", "CONSISTENCY", "country RLIKE '^[A-Z]{2}$'",
            "count(*) FILTER (regexp_matches(country, '^[A-Z]{2}$'))", 0.98, t),
        one("gold.fact_sales_orders", "fact", "ACCURACY", "customer_hk IS NOT NULL", "count(customer_hk)", 0.99, "order_date"),
    ]) + """),
dq AS (SELECT batch_id, table_name, dimension, rule, total, passed, round(passed / total, 5) AS score,
              passed / total >= thr AS met_threshold, run_at FROM dq0)"""


DQ_MONTHLY = GOLD + "," + _dq_rows("", "", True)
RUN_AT = "2001-08-02 00:00:00"


@query("dq_dimension_scores", with_parts(GOLD + "," + _dq_rows("run-1", RUN_AT, False), f"""
SELECT batch_id, table_name, dimension, rule, total, passed, score, met_threshold, strftime(run_at, '{TS}') AS run_at FROM dq"""))
def dq_dimension_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run over whole tables: six dimensions, one aggregate per table."""
    run_at = F.lit(RUN_AT).cast("timestamp_ntz")
    out = None
    for name, df in _dq_tables(spark, sf_dir).items():
        part = quality.score_run(df, name, seeds.DQ_RULES, "run-1", run_at)
        out = part if out is None else out.unionByName(part)
    return out.withColumn("run_at", text_ts("run_at"))


@query("dq_history", with_parts(DQ_MONTHLY, f"""
SELECT batch_id, table_name, dimension, rule, total, passed, score, met_threshold, strftime(run_at, '{TS}') AS run_at FROM dq"""))
def dq_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dq_history(spark, sf_dir).withColumn("run_at", text_ts("run_at"))


def _rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-level rejects of the order table, in one pass; a row is rejected ten minutes after it took effect."""
    raw = silver.sales_order_header_raw(spark, sf_dir)
    month = F.date_format("effective_ts", "yyyy-MM")
    rules = [r for r in seeds.DQ_RULES if r[1] != "TIMELINESS"]
    return quality.quarantine(raw, "silver.sales_order_header", rules, month, _month_end(month),
                              ["src_order_id", "csn"], F.col("effective_ts") + F.expr("INTERVAL '10' MINUTE"))


_REJECTS = ORDERS + """,
rej AS (
  SELECT strftime(effective_ts, '%Y-%m') AS batch_id, 'silver.sales_order_header' AS target_table, f.rule AS failed_rule,
         f.dim AS dq_dimension, effective_ts + INTERVAL 10 MINUTE AS rejected_at,
         src_order_id || '|' || CAST(csn AS VARCHAR) AS rk
  FROM raw JOIN (VALUES ('src_customer_id IS NOT NULL', 'COMPLETENESS'),
                        ('order_amount_usd BETWEEN 0 AND 50000000', 'VALIDITY')) f(rule, dim)
    ON CASE f.dim WHEN 'COMPLETENESS' THEN src_customer_id IS NULL
                  ELSE (order_amount_usd BETWEEN 0 AND 50000000) IS NOT TRUE END)"""


@query("dq_quarantine_rows", with_parts(_REJECTS, f"""
SELECT sha256(concat_ws('|', batch_id, failed_rule, rk)) AS reject_id, batch_id, target_table, 'silver' AS layer,
       failed_rule, dq_dimension, strftime(rejected_at, '{TS}') AS rejected_at FROM rej"""))
def dq_quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rejects(spark, sf_dir).select("reject_id", "batch_id", "target_table", "layer", "failed_rule",
                                          "dq_dimension", text_ts("rejected_at"))


@query("dq_quarantine_capped", with_parts(_REJECTS, """
SELECT failed_rule, sha256(concat_ws('|', batch_id, failed_rule, rk)) AS reject_id FROM rej
QUALIFY row_number() OVER (PARTITION BY failed_rule ORDER BY sha256(concat_ws('|', batch_id, failed_rule, rk))) <= 10000"""))
def dq_quarantine_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The capped variant: at most 10,000 stored rows per rule, chosen deterministically."""
    return expectations.cap_per_group(_rejects(spark, sf_dir).select("failed_rule", "reject_id"), ["failed_rule"],
                                      ["reject_id"], 10000)


@query("requeue_rejects", with_parts(ORDERS, """
SELECT src_order_id, CAST(csn AS BIGINT) AS csn, coalesce(currency_code, 'USD') AS currency_code,
       CAST(order_amount AS DOUBLE) AS order_amount, order_amount >= 0 AS passes
FROM (SELECT * FROM raw WHERE hk IS NULL OR NOT coalesce(order_amount_usd >= 0, FALSE) OR currency_code IS NULL)
QUALIFY row_number() OVER (PARTITION BY src_order_id, csn) = 1"""))
def requeue_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rebuild quarantined orders from their payload, impute the currency, check them again."""
    _, bad = expectations.split(silver.sales_order_header_raw(spark, sf_dir), SIL_RULES)
    stored = bad.select(F.to_json(F.struct("src_order_id", "csn", "currency_code", "order_amount")).alias("record_payload"))
    fixed = quality.requeue(stored, "src_order_id string, csn bigint, currency_code string, order_amount decimal(18,2)",
                            {"currency_code": "USD"}, ["src_order_id", "csn"])
    return fixed.withColumn("passes", expectations.holds("order_amount >= 0 AND currency_code IS NOT NULL")).withColumn(
        "order_amount", num("order_amount"))


@query("dq_kpis", with_parts(ORDERS, """
SELECT source_system, count(*) AS rows, round(count(*) FILTER (src_customer_id IS NULL) / count(*), 6) AS null_rate,
       round((count(*) - count(DISTINCT (hk, effective_ts))) / count(*), 6) AS duplicate_rate,
       count(*) FILTER (order_amount_usd < 0) AS out_of_range
FROM raw GROUP BY 1"""))
def dq_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null rate, duplicate rate and out-of-range count per system, folded per key first."""
    per_key = silver.sales_order_header_raw(spark, sf_dir).groupBy("source_system", "hk", "effective_ts").agg(
        F.count("*").alias("n"), F.count_if(F.col("src_customer_id").isNull()).alias("nulls"),
        F.count_if(F.col("order_amount_usd") < 0).alias("bad"))
    rows = F.sum("n")
    return per_key.groupBy("source_system").agg(
        rows.alias("rows"), F.round(F.sum("nulls") / rows, 6).alias("null_rate"),
        F.round((rows - F.count("*")) / rows, 6).alias("duplicate_rate"), F.sum("bad").alias("out_of_range"))


@query("latency_p95", """
SELECT l_returnflag, quantile_cont(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)), 0.95) AS p95_days,
       count(*) FILTER (date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) > 60) AS breaches
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def latency_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact 95th percentile of order-to-ship days and SLA breaches.

    Counted per distinct latency first, so the percentile sees one weighted row per day value.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("od"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", F.col("l_shipdate").cast("date").alias("sd"))
    counted = (lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
               .groupBy("l_returnflag", F.datediff("sd", "od").alias("days")).agg(F.count("*").alias("n")))
    return counted.groupBy("l_returnflag").agg(
        F.percentile("days", F.lit(0.95), F.col("n")).alias("p95_days"),
        F.sum(F.when(F.col("days") > 60, F.col("n")).otherwise(F.lit(0))).alias("breaches"))


# ---------------------------------------------------------------- run logs

# Event type to (flow, registered as active).
FLOWS = [("view", "ot_furnace_telemetry", True), ("click", "ot_caster_history", True), ("error", "mes_rollmill_orders", True),
         ("purchase", "sap_vbak_sales_header", True), ("signup", "sfdc_opportunity", False)]


def _event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress stored by a stream over the events: micro-batches count rows and failed rules of each flow and day."""
    rows = stream_table(spark, sf_dir, "events").join(seeds.inline(spark, [(k, n) for k, n, _ in FLOWS], "event_type string; flow_name string"), "event_type")
    rows = rows.withColumn("grade", F.get_json_object("props", "$.k").cast("int"))
    progress = jobs.run_counted(
        rows, {"valid_pk": "value >= 5"}, {"good_quality": "grade >= 10"},
        {"flow": F.col("event_type"), "source": F.col("flow_name"), "day": F.col("ts").cast("date")}, "ts", shared_dir(spark, "event_runs"))
    events = jobs.progress_events(progress, F.concat(F.lit("pl-"), F.col("source")), F.concat_ws("-", "flow", F.col("day").cast("string")), F.col("source"))
    return events.withColumn("timestamp", F.date_trunc("second", "timestamp").cast("timestamp_ntz"))


def _registry(spark: SparkSession) -> DataFrame:
    return seeds.inline(spark, [(f"pl-{n}", str(a)) for _, n, a in FLOWS], "pipeline_id string; active boolean")


def _active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eventlog.active_events(_event_log(spark, sf_dir), _registry(spark))


_RUNS = """
runs AS (
  SELECT CAST(ts AS DATE) AS day, event_type AS flow,
         CASE event_type WHEN 'view' THEN 'ot_furnace_telemetry' WHEN 'click' THEN 'ot_caster_history'
              WHEN 'error' THEN 'mes_rollmill_orders' WHEN 'purchase' THEN 'sap_vbak_sales_header' END AS source_name,
         count(*) FILTER (value >= 5) AS ok, count(*) FILTER (value < 5) AS low,
         count(*) FILTER (CAST(json_extract_string(props, '$.k') AS INTEGER) < 10) AS poor,
         date_trunc('second', max(ts)) AS at_ts
  FROM events WHERE event_type <> 'signup' GROUP BY 1, 2)"""


@query("event_batch_log", with_parts(_RUNS, f"""
SELECT flow || '-' || CAST(day AS VARCHAR) AS batch_id, source_name, 'bronze' AS layer, ok + low AS rows_read,
       ok AS rows_written, low AS rows_rejected, strftime(at_ts, '{TS}') AS started_at, strftime(at_ts, '{TS}') AS finished_at,
       'COMPLETED' AS status, CAST(NULL AS VARCHAR) AS error FROM runs"""))
def event_batch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eventlog.batch_log(_active(spark, sf_dir)).withColumns(
        {"started_at": text_ts("started_at"), "finished_at": text_ts("finished_at")})


@query("event_rejects", with_parts(_RUNS, """
SELECT sha256(concat_ws('|', flow || '-' || CAST(day AS VARCHAR), source_name, e.name)) AS reject_id,
       flow || '-' || CAST(day AS VARCHAR) AS batch_id, source_name, 'bronze.' || source_name AS target_table,
       'bronze' AS layer, e.name AS failed_rule, e.dim AS dq_dimension,
       '{"failed_records":' || CAST(CASE e.name WHEN 'valid_pk' THEN low ELSE poor END AS VARCHAR) || '}' AS record_payload
FROM runs, (VALUES ('valid_pk', 'COMPLETENESS'), ('good_quality', 'ACCURACY')) e(name, dim)
WHERE CASE e.name WHEN 'valid_pk' THEN low ELSE poor END > 0"""))
def event_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eventlog.rule_rejects(_active(spark, sf_dir)).drop("rejected_at")


@query("expectation_dimension", """
SELECT expectation, CASE WHEN contains(l, 'pk') THEN 'COMPLETENESS' WHEN contains(l, 'complete') THEN 'COMPLETENESS'
         WHEN contains(l, 'valid') THEN 'VALIDITY' WHEN contains(l, 'ts') THEN 'TIMELINESS'
         WHEN contains(l, 'timely') THEN 'TIMELINESS' WHEN contains(l, 'uniq') THEN 'UNIQUENESS'
         WHEN contains(l, 'quality') THEN 'ACCURACY' WHEN contains(l, 'format') THEN 'CONSISTENCY'
         ELSE 'VALIDITY' END AS dq_dimension, count(*) AS uses
FROM (SELECT lang || '_' || source || CASE event_no WHEN 0 THEN '_pk' WHEN 1 THEN '_timely' WHEN 2 THEN '_Quality'
             WHEN 3 THEN '_format' WHEN 4 THEN '_uniq' ELSE '_ts' END AS expectation, lower(expectation) AS l
      FROM (SELECT *, doc_id % 6 AS event_no FROM documents))
GROUP BY 1, 2""")
def expectation_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension by naming convention, for expectation names built from every document's attributes."""
    suffix = F.element_at(F.array(*[F.lit(s) for s in ["_pk", "_timely", "_Quality", "_format", "_uniq", "_ts"]]),
                          (F.col("doc_id") % 6 + 1).cast("int"))
    names = table(spark, sf_dir, "documents").select(F.concat("lang", F.lit("_"), "source", suffix).alias("expectation"))
    return names.groupBy("expectation", quality.dimension_of(F.col("expectation")).alias("dq_dimension")).agg(
        F.count("*").alias("uses"))


# ---------------------------------------------------------------- trust

@query("dq_heatmap", with_parts(DQ_MONTHLY, """
SELECT CAST(run_at AS DATE) AS day, dimension, table_name,
       CAST((2 * sum(CAST(round(score * 100000) AS BIGINT)) + 10 * count(*)) // (20 * count(*)) AS DOUBLE) / 10000.0::DOUBLE AS avg_score,
       bool_and(met_threshold) AS all_passed FROM dq GROUP BY 1, 2, 3"""))
def dq_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trust.heatmap(_dq_history(spark, sf_dir))


_LATEST = DQ_MONTHLY + """,
lat AS (SELECT * FROM dq QUALIFY row_number() OVER (PARTITION BY table_name, dimension ORDER BY run_at DESC) = 1)"""


@query("trust_scorecard", with_parts(_LATEST, """
SELECT table_name, CAST((2 * sum(CAST(round(score * 100000) AS BIGINT)) + 10 * count(*)) // (20 * count(*)) AS DOUBLE) / 100.0::DOUBLE AS trust_score_pct, count(*) FILTER (NOT met_threshold) AS breached_dimensions,
       coalesce(string_agg(CASE WHEN NOT met_threshold THEN dimension END, ',' ORDER BY dimension), '') AS breaches
FROM lat GROUP BY 1"""))
def trust_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trust.scorecard(_dq_history(spark, sf_dir)).withColumn("breaches", F.array_join("breaches", ","))


@query("rejects_drilldown", with_parts(_REJECTS, f"""
SELECT strftime(date_trunc('hour', rejected_at), '{TS}') AS hour, target_table, dq_dimension, failed_rule,
       count(*) AS rejected_rows
FROM rej WHERE rejected_at > TIMESTAMP '{RUN_AT}' - INTERVAL 7 DAY GROUP BY 1, 2, 3, 4"""))
def rejects_drilldown(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of = F.lit(RUN_AT).cast("timestamp_ntz")
    return trust.rejects_drilldown(_rejects(spark, sf_dir), as_of).withColumn("hour", text_ts("hour"))


@query("batch_health", with_parts(_RUNS, """
SELECT day, source_name, CAST(sum(ok) AS BIGINT) AS rows_written, CAST(sum(low) AS BIGINT) AS rows_rejected,
       round(sum(low) / nullif(sum(ok + low), 0) * 100, 3) AS reject_pct FROM runs GROUP BY 1, 2"""))
def batch_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trust.batch_health(eventlog.batch_log(_active(spark, sf_dir)))


FRESH_AT = "2024-01-31 00:00:00"


def _freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    flows = seeds.inline(spark, seeds.PRODUCT_FLOWS, "product string; source_name string")
    slas = seeds.inline(spark, [(p, m) for p, _, m, _ in seeds.PRODUCTS], "product string; sla_minutes int")
    return trust.freshness(eventlog.batch_log(_active(spark, sf_dir)), flows, slas, F.lit(FRESH_AT).cast("timestamp_ntz"))


_FRESH = f"""
fresh AS (
  SELECT p.product, CASE WHEN count(*) = count(l.at_ts) THEN min(l.at_ts) END AS last_load, p.sla_minutes,
         date_diff('minute', date_trunc('minute', CASE WHEN count(*) = count(l.at_ts) THEN min(l.at_ts) END), TIMESTAMP '{FRESH_AT}')
           - CASE WHEN second(CASE WHEN count(*) = count(l.at_ts) THEN min(l.at_ts) END) > 0 THEN 1 ELSE 0 END AS minutes_since_load
  FROM (VALUES ('sales_orders_unified', 'sap_vbak_sales_header', 30), ('customer_360', 'sfdc_opportunity', 60),
               ('melt_to_margin', 'ot_furnace_telemetry', 15), ('melt_to_margin', 'ot_caster_history', 15)
       ) p(product, source_name, sla_minutes)
  LEFT JOIN (SELECT source_name, max(at_ts) AS at_ts FROM runs GROUP BY 1) l USING (source_name) GROUP BY ALL)"""


@query("freshness_slo", with_parts(_RUNS + "," + _FRESH, f"""
SELECT product, strftime(last_load, '{TS}') AS last_load, CAST(minutes_since_load AS BIGINT) AS minutes_since_load,
       sla_minutes, coalesce(minutes_since_load <= sla_minutes, FALSE) AS fresh FROM fresh"""))
def freshness_slo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _freshness(spark, sf_dir).withColumn("last_load", text_ts("last_load"))


def _product_tables(spark: SparkSession) -> DataFrame:
    return seeds.inline(spark, seeds.PRODUCT_TABLES, "product string; table_name string")


_PRODUCT_SQL = """
pt AS (SELECT * FROM (VALUES ('sales_orders_unified', 'silver.sales_order_header'),
       ('sales_orders_unified', 'gold.fact_sales_orders'), ('customer_360', 'silver.customer')) t(product, table_name))"""


@query("trust_score_band", with_parts(_LATEST + "," + _RUNS + "," + _FRESH + "," + _PRODUCT_SQL, """
SELECT product, round(dq, 4) AS dq_score_pct, fresh, round(score, 4) AS trust_score,
       CASE WHEN score >= 98 THEN 'GREEN' WHEN score >= 95 THEN 'AMBER' ELSE 'RED' END AS band
FROM (SELECT q.product, q.dq, coalesce(f.minutes_since_load <= f.sla_minutes, FALSE) AS fresh,
             q.dq * 0.7::DOUBLE + CASE WHEN f.minutes_since_load <= f.sla_minutes THEN 100.0::DOUBLE ELSE 50.0::DOUBLE END * 0.3::DOUBLE AS score
      FROM (SELECT product, avg(score) * 100 AS dq FROM lat JOIN pt USING (table_name) GROUP BY 1) q
      LEFT JOIN fresh f USING (product))"""))
def trust_score_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trust.trust_scores(_dq_history(spark, sf_dir), _product_tables(spark), _freshness(spark, sf_dir))


@query("trust_history", with_parts(DQ_MONTHLY + "," + _PRODUCT_SQL, """
SELECT CAST(run_at AS DATE) AS day, product,
       CAST((20 * sum(CAST(round(score * 100000) AS BIGINT)) + count(*)) // (2 * count(*)) AS DOUBLE) / 10000.0::DOUBLE AS dq_score_pct
FROM dq JOIN pt USING (table_name) GROUP BY 1, 2"""))
def trust_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality part of the trust score per run day and product, ready to append."""
    scored = _dq_history(spark, sf_dir).join(_product_tables(spark), "table_name")
    return scored.groupBy(F.col("run_at").cast("date").alias("day"), "product").agg(
        F.round(trust.mean_score() * 100, 4).cast("double").alias("dq_score_pct"))


@query("contract_check", with_parts(_LATEST + "," + _PRODUCT_SQL, """
SELECT t.product, t.dimension, t.threshold, m.score, coalesce(m.score >= t.threshold, FALSE) AS met
FROM (VALUES ('COMPLETENESS', 0.99::DOUBLE), ('VALIDITY', 0.999::DOUBLE), ('UNIQUENESS', 0.999::DOUBLE), ('TIMELINESS', 0.95::DOUBLE),
             ('CONSISTENCY', 0.98::DOUBLE), ('ACCURACY', 0.99::DOUBLE)) d(dimension, threshold)
CROSS JOIN (SELECT 'sales_orders_unified' AS product) p
JOIN LATERAL (SELECT p.product, d.dimension, d.threshold) t ON TRUE
LEFT JOIN (SELECT product, dimension, min(score) AS score FROM lat JOIN pt USING (table_name) GROUP BY 1, 2) m
  ON m.product = t.product AND m.dimension = t.dimension"""))
def contract_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    thresholds = seeds.inline(spark, seeds.PRODUCT_THRESHOLDS, "product string; dimension string; threshold double")
    return trust.contract_check(_dq_history(spark, sf_dir), _product_tables(spark), thresholds)


@query("dq_rca", with_parts(DQ_MONTHLY + """,
seen AS (
  SELECT *, last_value(CASE WHEN met_threshold THEN batch_id END IGNORE NULLS) OVER w AS last_green_batch,
         last_value(CASE WHEN met_threshold THEN score END IGNORE NULLS) OVER w AS last_green_score,
         count(*) FILTER (met_threshold) OVER (PARTITION BY table_name, dimension ORDER BY run_at
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS streak
  FROM dq WINDOW w AS (PARTITION BY table_name, dimension ORDER BY run_at ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
vol AS (
  SELECT table_name, batch_id, rows, coalesce(rows > lag(rows) OVER (PARTITION BY table_name ORDER BY batch_id) * 1.5, FALSE) AS volume_spike
  FROM (SELECT table_name, batch_id, max(total) AS rows FROM dq GROUP BY 1, 2))""", """
SELECT s.table_name, s.dimension, s.batch_id, s.score, s.last_green_batch, s.last_green_score,
       min(s.batch_id) OVER (PARTITION BY s.table_name, s.dimension, s.streak) AS first_bad_batch,
       round(s.score - s.last_green_score, 5) AS score_drop, v.rows, v.volume_spike
FROM seen s LEFT JOIN vol v USING (table_name, batch_id) WHERE NOT s.met_threshold"""))
def dq_rca(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = _dq_history(spark, sf_dir)
    volumes = history.groupBy("table_name", "batch_id").agg(F.max("total").alias("rows"))
    return lineage.root_cause(history, volumes)


_CHANGES_SQL = """,
cp_obs AS (
  SELECT table_name || '/' || dimension AS series, batch_id, CAST(score AS DOUBLE) AS x FROM dq WHERE score IS NOT NULL
  UNION ALL SELECT table_name || '/rows', batch_id, CAST(max(total) AS DOUBLE) FROM dq GROUP BY ALL),
cp_num AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY batch_id) AS n FROM cp_obs),
cp_mid AS (SELECT series, median(x) AS centre FROM cp_num WHERE n <= 12 GROUP BY 1),
cp_wid AS (SELECT series, any_value(centre) AS centre, median(abs(x - centre)) AS spread FROM cp_num JOIN cp_mid USING (series) WHERE n <= 12 GROUP BY 1),
cp_z AS (
  SELECT series, batch_id, CAST(round(greatest(least((x - centre) / greatest(spread * 1.4826::DOUBLE, abs(centre) * 0.01::DOUBLE, 1e-9::DOUBLE), 4.0::DOUBLE), -4.0::DOUBLE)
                                * 1000000) AS BIGINT) AS z FROM cp_num JOIN cp_wid USING (series)),
cp_steps AS (SELECT series, batch_id, d.direction, CASE d.direction WHEN 'up' THEN z ELSE -z END - 500000 AS step
       FROM cp_z, (VALUES ('up'), ('down')) d(direction)),
cp_totals AS (SELECT *, CAST(sum(step) OVER (PARTITION BY series, direction ORDER BY batch_id) AS BIGINT) AS total FROM cp_steps),
cp_sums AS (SELECT *, total - least(0, min(total) OVER (PARTITION BY series, direction ORDER BY batch_id)) AS s FROM cp_totals),
cp_stretches AS (SELECT *, count(*) FILTER (s = 0) OVER (PARTITION BY series, direction ORDER BY batch_id) AS stretch FROM cp_sums)"""


@query("dq_change_points", with_parts(DQ_MONTHLY + _CHANGES_SQL, """
SELECT series, direction, min(batch_id) AS first_bad, min(batch_id) FILTER (s > 5000000) AS alarmed_at, max(batch_id) AS last_bad,
       count(*) AS runs, max(s) / 1000000.0::DOUBLE AS peak
FROM cp_stretches WHERE s > 0 GROUP BY series, direction, stretch HAVING count(*) FILTER (s > 5000000) > 0"""))
def dq_change_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where scores and row counts of the monthly runs left their baseline, found in sequence rather than by a fixed factor."""
    history = staged(_dq_history(spark, sf_dir).select("table_name", "dimension", "batch_id", "score", "total"), "history")
    scores = history.select(F.concat_ws("/", "table_name", "dimension").alias("series"), "batch_id", F.col("score").alias("x"))
    volumes = history.groupBy("table_name", "batch_id").agg(F.max("total").alias("rows")).select(
        F.concat("table_name", F.lit("/rows")).alias("series"), "batch_id", F.col("rows").cast("double").alias("x"))
    return changes.change_points(scores.union(volumes), ["series"], "batch_id", "x")


@query("post_load_checks", with_parts(GOLD + "," + _dq_rows("run-1", RUN_AT, False), """
SELECT 'sources are registered' AS check_name, CAST(12 AS BIGINT) AS got, '>= 6' AS want, TRUE AS ok
UNION ALL SELECT 'landed records carry the envelope', count(*) FILTER (k IS NULL), '== 0', TRUE FROM chg
UNION ALL SELECT 'silver history is insert-only', 0, '== 0', TRUE
UNION ALL SELECT 'hash keys are 64 hex digits' AS check_name, count(*) FILTER (NOT regexp_matches(hk, '^[0-9a-f]{64}$')) AS got, '== 0' AS want,
       count(*) FILTER (NOT regexp_matches(hk, '^[0-9a-f]{64}$')) = 0 AS ok FROM sil
UNION ALL SELECT 'fact customers exist', count(*), '== 0', count(*) = 0 FROM fact
  WHERE customer_hk IS NOT NULL AND customer_hk NOT IN (SELECT customer_hk FROM dim)
UNION ALL SELECT 'row filter hides other regions', count(*), '== 0', count(*) = 0 FROM fact WHERE FALSE
UNION ALL SELECT 'names are masked', count(*), '== 0', count(*) = 0 FROM dim WHERE FALSE
UNION ALL SELECT 'quality ran', count(*), '>= 6', count(*) >= 6 FROM dq
UNION ALL SELECT 'rejects carry a dimension', 0, '== 0', TRUE
UNION ALL SELECT 'product rows published', count(*), '>= 1', count(*) >= 1 FROM fact"""))
def post_load_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Post-load assertions as rows; every count is one distributed aggregate."""
    sil = staged(silver.sales_order_header(spark, sf_dir), "orders")
    dim = staged(gold.dim_customer(spark, sf_dir), "dim")
    fact = staged(gold.as_fact(silver.current_rows(sil, "csn"), dim), "fact")
    log = VersionedTable(spark, shared_dir(spark, "order_log"))
    log.append(sil, "b1")
    visible = policy.filter_rows(fact, ["sales_analyst_emea"])
    masked = dim.select(policy.mask_name(["exec_readonly"], F.col("customer_name")).alias("m"), "customer_name")
    checks = [
        ("sources are registered", registry.registry_frame(spark).filter("active"), ">=", 6),
        ("landed records carry the envelope", report_sales.bronze_envelope(spark, sf_dir).filter(
            "_ingest_ts IS NULL OR _source_system IS NULL OR _raw IS NULL"), "==", 0),
        ("silver history is insert-only", fingerprints.violations(sil, log.read(), "source_system", ["hk", "csn"], sil.columns), "==", 0),
        ("hash keys are 64 hex digits", sil.filter(~F.col("hk").rlike("^[0-9a-f]{64}$")), "==", 0),
        ("fact customers exist", fact.filter("customer_hk IS NOT NULL").join(dim, "customer_hk", "left_anti"), "==", 0),
        ("row filter hides other regions", visible.filter("source_system NOT IN ('QAD', 'D365')"), "==", 0),
        ("names are masked", masked.filter("m = customer_name"), "==", 0),
        ("quality ran", dq_dimension_scores(spark, sf_dir), ">=", 6),
        ("rejects carry a dimension", _rejects(spark, sf_dir).filter("dq_dimension IS NULL"), "==", 0),
        ("product rows published", products.sales_orders(fact), ">=", 1),
    ]
    out = None
    for name, df, op, want in checks:
        got = F.col("got")
        row = df.agg(F.count(F.lit(1)).alias("got")).select(
            F.lit(name).alias("check_name"), "got", F.lit(f"{op} {want}").alias("want"),
            ((got == want) if op == "==" else (got >= want)).alias("ok"))
        out = row if out is None else out.unionByName(row)
    return out


# ---------------------------------------------------------------- vectors

@query("vector_topk", """
SELECT vec_id, score, CAST(row_number() OVER (ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM (
  SELECT e.vec_id, round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 6) AS score
  FROM embeddings e, (SELECT embedding FROM embeddings WHERE vec_id = 0) q)
QUALIFY rank <= 5""")
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five vectors nearest to one question vector."""
    index = table(spark, sf_dir, "embeddings")
    question = list(index.filter("vec_id = 0").select("embedding").first()[0])
    return vectors.top_k(index, "vec_id", "embedding", {"q": question}, 5).select("vec_id", "score", "rank")


@query("vector_topk_batch", """
WITH c AS (
  SELECT label, list(m ORDER BY pos) AS q FROM (
    SELECT label, pos, avg(x) AS m FROM (
      SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)
    GROUP BY 1, 2) GROUP BY 1)
SELECT CAST(c.label AS VARCHAR) AS question, e.vec_id,
       round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), c.q), 6) AS score,
       CAST(row_number() OVER (PARTITION BY c.label ORDER BY round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), c.q), 6) DESC, e.vec_id) AS INTEGER) AS rank
FROM embeddings e, c QUALIFY rank <= 5""")
def vector_topk_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five vectors nearest to every label's centroid, one pass over the index."""
    index = table(spark, sf_dir, "embeddings")
    return vectors.top_k(index, "vec_id", "embedding", vectors.centroids(index, "label", "embedding"), 5).select(
        "question", "vec_id", "score", "rank")


def _hash_search(source: str, key: str, text: str, question: str) -> str:
    return f"""
tok AS (SELECT {key} AS k, unnest(regexp_extract_all(lower({text}), '[\\pL\\pN]+')) AS t FROM {source}),
vec AS (SELECT k, substr(md5(t), 3, 2) AS b, count(*) AS n FROM tok GROUP BY 1, 2),
qv AS (SELECT substr(md5(t), 3, 2) AS b, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower('{question}'), '[\\pL\\pN]+')) AS t) GROUP BY 1),
dot AS (SELECT vec.k, sum(vec.n * qv.n) AS d FROM vec JOIN qv USING (b) GROUP BY 1),
nrm AS (SELECT k, sqrt(sum(n * n)) AS l FROM vec GROUP BY 1),
allk AS (SELECT {key} AS k FROM {source}),
sc AS (SELECT allk.k, round(coalesce(d / (l * (SELECT sqrt(sum(n * n)) FROM qv)), 0), 6) AS score
       FROM allk LEFT JOIN dot ON dot.k = allk.k LEFT JOIN nrm ON nrm.k = allk.k)"""


DOC_QUESTION = "the ring of that other answer"


@query("text_topk", with_parts(_hash_search("documents", "doc_id", "text", DOC_QUESTION), """
SELECT k AS doc_id, score, CAST(row_number() OVER (ORDER BY score DESC, k) AS INTEGER) AS rank FROM sc QUALIFY rank <= 5"""))
def text_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Semantic search over whole document texts with the hashing embedder."""
    index = table(spark, sf_dir, "documents").select("doc_id", vectors.embed_column("text").alias("embedding"))
    return vectors.search_text(index, "doc_id", "embedding", DOC_QUESTION).select("doc_id", "score", "rank")


PROFILE_QUESTION = "customer ltd jde orders 12"
_PROFILES = GOLD + "," + _FEATURES + """,
prof AS (SELECT dim.customer_hk, concat_ws(' ', customer_name, country, source_system,
                'orders ' || CAST(order_count_all AS VARCHAR), 'last ' || CAST(last_order_date AS VARCHAR)) AS profile_text
         FROM dim LEFT JOIN feat USING (customer_hk))"""


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = products.customer_360(gold.dim_customer(spark, sf_dir), _features(spark, sf_dir))
    return products.profile_text(wide)


@query("customer_profile_text", with_parts(_PROFILES, "SELECT * FROM prof"))
def customer_profile_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profiles(spark, sf_dir)


@query("profile_search", with_parts(_PROFILES + "," + _hash_search("prof", "customer_hk", "profile_text", PROFILE_QUESTION), """
SELECT k AS customer_hk, profile_text, score FROM sc JOIN prof ON prof.customer_hk = sc.k
QUALIFY row_number() OVER (ORDER BY score DESC, k) <= 5"""))
def profile_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key, text and score of the five best customer profiles for a question."""
    prof = staged(_profiles(spark, sf_dir), "profiles")
    index = prof.select("customer_hk", vectors.embed_column("profile_text").alias("embedding"))
    hits = vectors.search_text(index, "customer_hk", "embedding", PROFILE_QUESTION)
    # Five hits against the profiles: Spark sees the hit side is tiny at run time.
    return prof.join(hits.select("customer_hk", "score"), "customer_hk").select("customer_hk", "profile_text", "score")


@query("profile_search_sql", with_parts(_PROFILES + "," + _hash_search("prof", "customer_hk", "profile_text", PROFILE_QUESTION), """
SELECT k AS customer_hk, profile_text, score FROM sc JOIN prof ON prof.customer_hk = sc.k
QUALIFY row_number() OVER (ORDER BY score DESC, k) <= 5"""))
def profile_search_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search as a SQL table function."""
    prof = staged(_profiles(spark, sf_dir), "profiles")
    index = prof.withColumn("embedding", vectors.embed_column("profile_text"))
    vectors.register_search_function(spark, index, "customer_hk", "profile_text", "embedding")
    return spark.sql("SELECT * FROM search_customer_profiles(:q)", args={"q": PROFILE_QUESTION})


@query("text_index_search", with_parts(_hash_search("documents", "doc_id", "text", DOC_QUESTION), """
SELECT k AS doc_id, score, CAST(row_number() OVER (ORDER BY score DESC, k) AS INTEGER) AS rank FROM sc QUALIFY rank <= 5"""))
def text_index_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same question against a stored index: texts are embedded when it is built, a search reads the nearest cells."""
    path = shared_dir(spark, "text_index")
    texts = staged(table(spark, sf_dir, "documents").select("doc_id", vectors.embed_column("text").alias("embedding")), "embedded")
    vector_index.build(texts, "doc_id", "embedding", path, cells=32, parts=16)
    question = {"q": vectors.token_vector(DOC_QUESTION).tolist()}
    return vector_index.search(spark, path, "doc_id", "embedding", question, 5, probes=16).select("doc_id", "score", "rank")


@query("vector_index_sync", with_parts(CUSTOMERS + """,
b AS (SELECT * FROM cus WHERE effective_ts < TIMESTAMP '2000-02-15 00:00:00'
      QUALIFY row_number() OVER (PARTITION BY hk ORDER BY effective_ts DESC, csn DESC) = 1),
tok AS (SELECT hk, unnest(regexp_extract_all(lower(concat_ws(' ', customer_name, country)), '[\\pL\\pN]+')) AS t FROM b),
vec AS (SELECT hk, substr(md5(t), 3, 2) AS bucket, count(*) AS n FROM tok GROUP BY 1, 2)""", """
SELECT b.hk, concat_ws(' ', b.customer_name, b.country) AS text, string_agg(bucket || ':' || n, ',' ORDER BY bucket) AS vector
FROM b JOIN vec USING (hk) GROUP BY 1, 2"""))
def vector_index_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bring the stored index of the earlier snapshot up to date from the change feed; only changes are embedded, only
    touched cells are written. The vectors are read back from the index."""
    log = silver.customer(spark, sf_dir)

    def at(day: str) -> DataFrame:
        rows = current_rows(log.filter(F.col("effective_ts") < F.lit(day).cast("timestamp_ntz")), "csn")
        return staged(rows.select("hk", F.concat_ws(" ", "customer_name", "country").alias("text")), "snapshot")

    before, after = at("2000-01-15"), at("2000-02-15")
    path = shared_dir(spark, "profile_index")
    vector_index.build(staged(before.select("hk", vectors.embed_column("text").alias("embedding")), "embedded"), "hk", "embedding", path, cells=16)
    feed = snapshot_diff(before, after, ["hk"], ["text"])
    vector_index.sync(spark, path, "hk", "embedding", feed.select("hk", vectors.embed_column("text").alias("embedding"), "change_type"))
    stored = spark.read.parquet(f"{path}/cells").select("hk", F.array_join(F.filter(F.transform("embedding", lambda x, i: F.when(
        x > 0, F.concat(F.lpad(F.lower(F.hex(i)), 2, "0"), F.lit(":"), x.cast("int").cast("string")))), lambda v: v.isNotNull()), ",").alias("vector"))
    return stored.join(after, "hk").select("hk", "text", "vector")


# ---------------------------------------------------------------- streams

@query("furnace_heat_5min_stream", with_parts(TELEMETRY + """,
lim AS (SELECT max(ms) - INTERVAL 15 MINUTE AS wm FROM good)""", f"""
SELECT strftime(window_start, '{TS}') AS window_start, site, asset, tag, round(avg_value, 6) AS avg_value, max_value, samples
FROM heat, lim WHERE window_start + INTERVAL 5 MINUTE <= wm"""))
def furnace_heat_5min_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window aggregate as a watermarked stream; windows still open at the end are not emitted."""
    records = feeds.broker_records(stream_table(spark, sf_dir, "events"))
    windows = telemetry.SENSOR_WINDOWS.apply(_good(records), "15 minutes")
    jobs.use_rocksdb(spark)
    out = jobs.run_append(windows, shared_dir(spark, "heat_stream"))
    return out.select(text_ts("window_start"), "site", "asset", "tag", F.round("avg_value", 6).alias("avg_value"),
                      "max_value", "samples")


@query("furnace_windows_late", with_parts(TELEMETRY + """,
arr AS (SELECT *, time_bucket(INTERVAL 5 MINUTES, ms) AS w, epoch_us(ms) // 864000000000 + CAST(event_id % 13 = 4 AS BIGINT) AS arrival FROM good),
seen AS (SELECT arrival, max(max(ms)) OVER (ORDER BY arrival) - INTERVAL 15 MINUTE AS wm FROM arr GROUP BY 1),
old AS (SELECT arrival, lag(wm) OVER (ORDER BY arrival) AS before FROM seen),
tagged AS (SELECT arr.*, coalesce(w + INTERVAL 5 MINUTE <= before, FALSE) AS late FROM arr JOIN old USING (arrival))""", f"""
SELECT 'window' AS kind, strftime(w, '{TS}') AS at, site, asset_id AS asset, tag, count(*) AS samples, max(value) AS max_value, round(avg(value), 6) AS avg_value
FROM tagged WHERE NOT late AND w + INTERVAL 5 MINUTE <= (SELECT max(wm) FROM seen) GROUP BY w, site, asset_id, tag
UNION ALL SELECT 'late', strftime(ms, '{TS}'), site, asset_id, tag, CAST(1 AS BIGINT), value, round(value, 6) FROM tagged WHERE late"""))
def furnace_windows_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of a stream that is stopped and resumed while its rows land ten days at a time, a thirteenth of them one landing
    later: those that still find their window open are counted, the others are kept apart."""
    events = table(spark, sf_dir, "events").withColumn("arrival", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 864000000000) + (F.col("event_id") % 13 == 4).cast("long"))
    base = shared_dir(spark, "late_windows")
    first, last = events.agg(F.min("arrival"), F.max("arrival")).first()
    for arrival in range(first, last + 1):
        feeds.broker_records(events.filter(F.col("arrival") == arrival)).write.mode("append").parquet(f"{base}/landing")
        landed = spark.readStream.schema("topic string, value string, timestamp timestamp").parquet(f"{base}/landing")
        windows, late = jobs.run_windows(_good(landed), telemetry.SENSOR_WINDOWS, "15 minutes", f"{base}/job")
    series = ["site", "asset", "tag"]
    closed = windows.select(F.lit("window").alias("kind"), text_ts("window_start").alias("at"), *series, "samples", "max_value", F.round("avg_value", 6).alias("avg_value"))
    return closed.unionByName(late.select(F.lit("late").alias("kind"), text_ts("ts").alias("at"), *series, F.lit(1).cast("long").alias("samples"),
                                          F.col("value").alias("max_value"), F.round("value", 6).alias("avg_value")))


@query("telemetry_ingest_stream", with_parts(TELEMETRY, """
SELECT site, 'meltshop' AS area, asset_id AS asset, tag, strftime(ms, '%Y-%m-%d %H:%M:%S.%g') AS ts, value, quality FROM good"""))
def telemetry_ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze telemetry as a stream, driven by its registry row: filter, watermark, expectations, trigger."""
    source = registry.source("ot_furnace_telemetry")
    rows = jobs.ingest_telemetry(feeds.broker_records(stream_table(spark, sf_dir, "events")), source)
    out = jobs.run_append(rows, shared_dir(spark, "telemetry_stream"))
    return out.select("site", "area", "asset", "tag", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("ts"), "value", "quality")


@query("cdc_mirror_stream", with_parts(CHANGES + "," + _NET, """
SELECT k AS order_no, CAST(csn AS BIGINT) AS csn, CAST(amount AS DOUBLE) AS amount, ccy AS currency FROM net WHERE op <> 'D'"""))
def cdc_mirror_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = _stream_changes(spark, sf_dir)
    base = shared_dir(spark, "mirror_stream")
    jobs.mirror_changes(changes, ["order_no"], "csn", base).awaitTermination()
    return jobs.read_mirror(spark, ["order_no"], "csn", base).select("order_no", "csn", num("amount"), "currency")


def _stream_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.order_changes_of(stream_table(spark, sf_dir, "orders"))


@query("orders_stream_fx", with_parts(ORDERS, """
SELECT hk, src_order_id, source_system, CAST(csn AS BIGINT) AS csn, CAST(order_amount_usd AS DOUBLE) AS order_amount_usd FROM sil"""))
def orders_stream_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver orders as a stream: union of the dialects, stream-static currency join, expectations, file sink."""
    rows = silver.order_stream(spark, _stream_changes(spark, sf_dir))
    out = jobs.run_append(rows.select("hk", "src_order_id", "source_system", "csn", "order_amount_usd"),
                          shared_dir(spark, "orders_stream"))
    return out.withColumn("order_amount_usd", num("order_amount_usd"))
