"""Queries over the sales side: conformance, versions, CDC, star schema, metrics, policies, products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.functions.scalars import date_to_day_serial, day_serial_to_date, implied_decimal, ts_text
from ladle.operators import cdc, envelope, expectations, features, fingerprints, layout, lineage, linkage, mapping, policy, products, quality, versions
from ladle.operators.metrics import SALES_METRICS
from ladle.plans import gold, silver
from ladle.plans.oracle_parts import CHANGES, CUSTOMERS, GOLD, ORDERS, TS, with_parts
from ladle.session import shared_dir
from ladle.sinks import materialize, publish_view, write_clustered
from ladle.sources import feeds, registry, seeds
from ladle.sources.tables import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

AS_OF = "2001-08-02"


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return register


def staged(df: DataFrame, name: str) -> DataFrame:
    """Store a frame that several branches read, so that none of them computes it again."""
    return materialize(df, shared_dir(df.sparkSession, name))


def num(name: str) -> Column:
    return F.col(name).cast("double").alias(name)


def text_ts(name: str) -> Column:
    return ts_text(F.col(name)).alias(name)


# ---------------------------------------------------------------- conformance

@query("agg_sales_daily", with_parts(ORDERS, """
SELECT order_date, source_system, CAST(sum(order_amount_usd) AS DOUBLE) AS revenue_usd,
       CAST(count(DISTINCT hk) AS BIGINT) AS orders
FROM cur GROUP BY 1, 2"""))
def agg_sales_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.agg_sales_daily(spark, sf_dir).select("order_date", "source_system", num("revenue_usd"), "orders")


@query("silver_orders_conformed", with_parts(ORDERS, f"""
SELECT src_order_id, src_customer_id, CAST(order_amount AS DOUBLE) AS order_amount, currency_code, order_date,
       source_system, hk, record_hash, strftime(effective_ts, '{TS}') AS effective_ts FROM raw"""))
def silver_orders_conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.conformed_orders(spark, sf_dir).select(
        "src_order_id", "src_customer_id", num("order_amount"), "currency_code", "order_date", "source_system", "hk",
        "record_hash", text_ts("effective_ts"))


@query("silver_customer_conformed", with_parts(CUSTOMERS, f"""
SELECT src_customer_id, customer_name, country, source_system, hk, record_hash,
       strftime(effective_ts, '{TS}') AS effective_ts FROM cus"""))
def silver_customer_conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.customer(spark, sf_dir).select(
        "src_customer_id", "customer_name", "country", "source_system", "hk", "record_hash", text_ts("effective_ts"))


@query("fx_normalized_orders", with_parts(ORDERS, """
SELECT hk, currency_code, CAST(usd_rate AS DOUBLE) AS usd_rate, CAST(order_amount AS DOUBLE) AS order_amount,
       CAST(order_amount_usd AS DOUBLE) AS order_amount_usd FROM raw"""))
def fx_normalized_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.sales_order_header_raw(spark, sf_dir).select(
        "hk", "currency_code", num("usd_rate"), num("order_amount"), num("order_amount_usd"))


@query("scalar_functions", """
SELECT o_orderkey, sha256(concat_ws('|', 'SAP', CAST(o_orderkey AS VARCHAR))) AS key_hash,
       left(o_orderpriority, 2) || '*****' AS masked, lower(o_orderpriority) AS lowered,
       o_orderpriority LIKE '%URGENT%' AS is_urgent, regexp_matches(o_orderpriority, '^[1-5]-') AS well_formed,
       string_split(o_orderpriority, '-')[2] AS label, CAST(o_orderdate AS DATE) + 7 AS due_date,
       date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-02') AS age_days,
       strftime(date_trunc('month', o_orderdate), '%Y-%m-%d %H:%M:%S') AS month_start,
       date_diff('minute', o_orderdate, TIMESTAMP '2001-08-02 00:00:00') AS age_minutes,
       CAST(date_diff('day', DATE '1900-01-01', CAST(o_orderdate AS DATE)) + 36525 AS INTEGER) AS day_serial,
       CAST(o_orderdate AS DATE) AS from_serial,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS from_implied,
       round(o_totalprice / nullif(o_orderkey % 7, 0), 0) AS guarded_ratio,
       coalesce(CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' END, 'other') AS status_name,
       o_totalprice BETWEEN 1000 AND 200000 AS in_range, o_orderstatus IN ('F', 'O') AS known_status,
       o_orderdate >= TIMESTAMP '2001-08-02 00:00:00' - INTERVAL 365 DAY AS recent
FROM orders""")
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scalar function groups the pipelines use, over all orders."""
    day, prio = F.col("o_orderdate").cast("date"), F.col("o_orderpriority")
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    serial = date_to_day_serial(day)
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.sha2(F.concat_ws("|", F.lit("SAP"), F.col("o_orderkey").cast("string")), 256).alias("key_hash"),
        F.concat(F.left(prio, F.lit(2)), F.lit("*****")).alias("masked"), F.lower(prio).alias("lowered"),
        prio.like("%URGENT%").alias("is_urgent"), prio.rlike("^[1-5]-").alias("well_formed"),
        F.get(F.split(prio, "-"), F.lit(1)).alias("label"), F.date_add(day, 7).alias("due_date"),
        F.datediff(F.lit(AS_OF).cast("date"), day).cast("long").alias("age_days"),
        ts_text(F.date_trunc("month", "o_orderdate")).alias("month_start"),
        F.timestamp_diff("MINUTE", F.col("o_orderdate"), as_of).alias("age_minutes"),
        serial.alias("day_serial"), day_serial_to_date(serial).alias("from_serial"),
        implied_decimal(cents).cast("double").alias("from_implied"),
        F.round(F.col("o_totalprice") / F.nullif(F.col("o_orderkey") % 7, F.lit(0)), 0).alias("guarded_ratio"),
        F.coalesce(F.when(F.col("o_orderstatus") == "F", "final").when(F.col("o_orderstatus") == "O", "open"),
                   F.lit("other")).alias("status_name"),
        F.col("o_totalprice").between(1000, 200000).alias("in_range"),
        F.col("o_orderstatus").isin("F", "O").alias("known_status"),
        (F.col("o_orderdate") >= as_of - F.expr("INTERVAL '365' DAY")).alias("recent"))


_TAIL = """, '"op_type":"' || op || '"', '"csn":' || CAST(csn AS VARCHAR),
         '"changed_at":"' || strftime(at_ts, '%Y-%m-%dT%H:%M:%S.%g') || '"') || '}'"""


@query("bronze_envelope", with_parts(CHANGES, f"""
SELECT CASE owner WHEN 0 THEN 'SAP' WHEN 1 THEN 'JDE' ELSE 'QAD' END AS _source_system, '2001-08-01 06:00:00' AS _ingest_ts,
       'batch-1' AS _batch_id, op AS _op_type, CAST(csn AS BIGINT) AS _seq, op = 'D' AS is_deleted,
       CASE owner WHEN 0 THEN '{{' || concat_ws(',', '"VBELN":"00' || CAST(k + 4000000 AS VARCHAR) || '"',
         '"KUNNR":"EU' || lpad(CAST(c AS VARCHAR), 12, '0') || '"', '"NETWR":' || CAST(amount AS VARCHAR),
         '"WAERK":"' || ccy || '"', '"ERDAT":"' || CAST(od AS VARCHAR) || '"', '"MATNR":"MAT-' || CAST(k % 6 AS VARCHAR) || '"'{_TAIL}
       WHEN 1 THEN '{{' || concat_ws(',', '"SHKCOO":"00001"', '"SHDOCO":' || CAST(k + 100000 AS VARCHAR), '"SHDCTO":"SO"',
         '"SHAN8":' || CAST(c + 10000 AS VARCHAR), '"SHOTOT":' || CAST(CAST(amount * 100 AS BIGINT) AS VARCHAR),
         '"SHCRCD":"' || ccy || '"', '"SHTRDJ":' || CAST(date_diff('day', DATE '1900-01-01', od) + 36525 AS VARCHAR),
         '"SHLITM":"MAT-' || CAST(k % 6 AS VARCHAR) || '"'{_TAIL}
       ELSE '{{' || concat_ws(',', '"so_domain":"EMEA"', '"so_nbr":"SO' || CAST(k + 700000 AS VARCHAR) || '"',
         '"so_cust":"ME' || lpad(CAST(c AS VARCHAR), 12, '0') || '"', '"so_t_amt":' || CAST(amount AS VARCHAR),
         '"so_curr":"' || ccy || '"', '"so_ord_date":"' || CAST(od AS VARCHAR) || '"',
         '"so_part":"MAT-' || CAST(k % 6 AS VARCHAR) || '"'{_TAIL} END AS _raw
FROM chg"""))
def bronze_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The envelope of every landed order record of all systems; the raw row is JSON text."""
    at = F.lit("2001-08-01 06:00:00").cast("timestamp_ntz")
    landed = None
    for target, feed in feeds.order_feeds(spark, sf_dir).items():
        system = target.split(".")[1].upper()
        part = envelope.soft_delete_flag(envelope.with_envelope(feed, system, "batch-1", at, "op_type", "csn")).select(
            "_source_system", text_ts("_ingest_ts"), "_batch_id", "_op_type", "_seq", "_raw", "is_deleted")
        landed = part if landed is None else landed.unionByName(part)
    return landed


# ---------------------------------------------------------------- versions

@query("orders_current", with_parts(ORDERS, f"""
SELECT hk, src_order_id, source_system, order_date, CAST(order_amount_usd AS DOUBLE) AS order_amount_usd,
       strftime(effective_ts, '{TS}') AS effective_ts, CAST(csn AS BIGINT) AS csn FROM cur"""))
def orders_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.orders_current(spark, sf_dir).select(
        "hk", "src_order_id", "source_system", "order_date", num("order_amount_usd"), text_ts("effective_ts"), "csn")


@query("dim_customer", with_parts(CUSTOMERS, "SELECT * FROM dim"))
def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.dim_customer(spark, sf_dir)


_PARTY = """
party AS (
  SELECT c_nationkey, c_mktsegment, CASE cowner WHEN 0 THEN 'SAP' WHEN 1 THEN 'JDE' ELSE 'QAD' END AS source_system,
         name AS customer_name, country, at_ts AS effective_ts, csn, ck,
         CASE cowner WHEN 0 THEN 3 WHEN 1 THEN 2 ELSE 1 END AS rnk
  FROM cchg)"""


@query("customer_survivorship", with_parts(CUSTOMERS + "," + _PARTY, """
SELECT c_nationkey, c_mktsegment,
       arg_max(customer_name, (rnk, effective_ts, csn, ck)) FILTER (customer_name IS NOT NULL) AS customer_name,
       arg_max(country, (rnk, effective_ts, csn, ck)) FILTER (country IS NOT NULL) AS country,
       arg_max(source_system, (rnk, effective_ts, csn, ck)) AS source_system, count(*) AS contributors
FROM party GROUP BY 1, 2"""))
def customer_survivorship(spark: SparkSession, sf_dir: str) -> DataFrame:
    owner = F.col("owner")
    party = feeds.customer_changes(spark, sf_dir).select(
        "c_nationkey", "c_mktsegment", F.col("name").alias("customer_name"), "country",
        F.when(owner == 0, "SAP").when(owner == 1, "JDE").otherwise("QAD").alias("source_system"),
        F.col("changed_at").alias("effective_ts"), "csn", "cust_no")
    return versions.survivor(party, ["c_nationkey", "c_mktsegment"], seeds.SOURCE_PRIORITY,
                             ["customer_name", "country", "source_system"], ["effective_ts", "csn", "cust_no"])


LEGAL_FORMS = ["gmbh", "ltd"]
PARTY_FIELDS = [linkage.Field("party", close=1), linkage.Field("post_code", close=1), linkage.Field("nation"),
                linkage.Field("tax_id", common=20)]
PARTY_BLOCKS = [
    linkage.Block("array(tax_id)", ("substr(party, 1, 3)", "party")),
    linkage.Block("array(concat(nation, ':', post_code))", ("substr(party, 1, 3)", "party")),
    linkage.Block("transform(split(party, ' '), w -> concat(nation, ':', w))", ("party", "post_code")),
]

# The feed is made from the customer table, so the SQL knows which records belong together.
_RECORDS = """
recs AS (
  SELECT c_custkey AS k, c_custkey * 3 + s.i AS record_id, s.i AS i
  FROM customer, (VALUES (0), (1), (2)) s(i)
  WHERE i = 0 OR (i = 1 AND c_custkey % 2 = 0) OR (i = 2 AND c_custkey % 3 = 0))"""


def _party_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = staged(feeds.party_records(spark, sf_dir), "parties")
    named = records.withColumn("party", F.array_join(linkage.words("name", LEGAL_FORMS), " "))
    return linkage.resolve(named, "record_id", PARTY_FIELDS, PARTY_BLOCKS).join(records, "record_id")


@query("party_entities", f"""
WITH {_RECORDS}
SELECT record_id, k * 3 AS entity_id, count(*) OVER (PARTITION BY k) AS members FROM recs""")
def party_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every party record with its entity, found by learned record linkage."""
    return _party_entities(spark, sf_dir).select("record_id", "entity_id", "members")


@query("party_golden", """
WITH c AS (
  SELECT c_custkey AS k, CAST(c_nationkey AS VARCHAR) AS nation, md5(CAST(if(c_custkey % 29 = 0, c_custkey + 1, c_custkey) AS VARCHAR)) AS h,
         'T' || substr(md5('tax' || c_custkey), 1, 12) AS tax FROM customer),
w AS (SELECT *, translate(substr(h, 1, 7), '0123456789abcdef', 'bdfgklmnprstvzae') AS w1,
             translate(substr(h, 9, 6), '0123456789abcdef', 'bdfgklmnprstvzae') AS w2 FROM c)
SELECT k * 3 AS entity_id, upper(w1[1]) || w1[2:] || ' ' || upper(w2[1]) || w2[2:] || ' GmbH' AS name,
       lpad(CAST(k * 7919 % 100000 AS VARCHAR), 5, '0') AS post_code, nation,
       CASE WHEN k % 10 <> 3 THEN tax WHEN k % 3 = 0 THEN '000000000' END AS tax_id,
       CAST(1 + (k % 2 = 0)::INT + (k % 3 = 0)::INT AS BIGINT) AS contributors FROM w""")
def party_golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survivorship on matched entities: the best source of each column, over all records of an entity."""
    return versions.survivor(_party_entities(spark, sf_dir), ["entity_id"], seeds.SOURCE_PRIORITY,
                             ["name", "post_code", "nation", "tax_id"], ["record_id"])


@query("version_noop_suppressed", with_parts(CUSTOMERS, f"""
SELECT hk, CAST(csn AS BIGINT) AS csn, strftime(effective_ts, '{TS}') AS effective_ts, record_hash FROM (
  SELECT *, lag(record_hash) OVER (PARTITION BY hk ORDER BY effective_ts, csn) AS prev FROM cus)
WHERE prev IS DISTINCT FROM record_hash"""))
def version_noop_suppressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = versions.drop_noops(silver.customer(spark, sf_dir), ["effective_ts", "csn"])
    return kept.select("hk", "csn", text_ts("effective_ts"), "record_hash")


@query("scd2_intervals", with_parts(CUSTOMERS, f"""
SELECT hk, customer_name, strftime(effective_ts, '{TS}') AS valid_from, strftime(nxt, '{TS}') AS valid_to,
       nxt IS NULL AS is_current
FROM (SELECT *, lead(effective_ts) OVER (PARTITION BY hk ORDER BY effective_ts, csn) AS nxt FROM cus)"""))
def scd2_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = versions.validity_intervals(silver.customer(spark, sf_dir), ["effective_ts", "csn"])
    return spans.select("hk", "customer_name", text_ts("valid_from"), text_ts("valid_to"), "is_current")


# ---------------------------------------------------------------- change data capture

_NET = """
net AS (SELECT * FROM chg QUALIFY row_number() OVER (PARTITION BY k ORDER BY csn DESC) = 1)"""


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.order_changes(spark, sf_dir)


@query("cdc_net_changes", with_parts(CHANGES + "," + _NET, """
SELECT k AS order_no, op AS op_type, CAST(csn AS BIGINT) AS csn, CAST(amount AS DOUBLE) AS amount, currency_code
FROM (SELECT *, ccy AS currency_code FROM net)"""))
def cdc_net_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.net_changes(_changes(spark, sf_dir), ["order_no"], "csn").select(
        "order_no", "op_type", "csn", num("amount"), F.col("currency").alias("currency_code"))


@query("cdc_scd1_mirror", with_parts(CHANGES + "," + _NET, """
SELECT k AS order_no, CAST(csn AS BIGINT) AS csn, CAST(amount AS DOUBLE) AS amount, ccy AS currency, od AS order_date
FROM net WHERE op <> 'D'"""))
def cdc_scd1_mirror(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.scd1_mirror(_changes(spark, sf_dir), ["order_no"], "csn").select(
        "order_no", "csn", num("amount"), "currency", "order_date")


@query("cdc_snapshot_diff", with_parts(CUSTOMERS + """,
a AS (SELECT * FROM cus WHERE effective_ts < TIMESTAMP '2000-01-15 00:00:00'
      QUALIFY row_number() OVER (PARTITION BY hk ORDER BY effective_ts DESC, csn DESC) = 1),
b AS (SELECT * FROM cus WHERE effective_ts < TIMESTAMP '2000-02-15 00:00:00'
      QUALIFY row_number() OVER (PARTITION BY hk ORDER BY effective_ts DESC, csn DESC) = 1)""", """
SELECT coalesce(a.hk, b.hk) AS hk, b.customer_name, b.country,
       CASE WHEN a.hk IS NULL THEN 'insert' WHEN b.hk IS NULL THEN 'delete' ELSE 'update' END AS change_type
FROM a FULL OUTER JOIN b ON a.hk = b.hk
WHERE a.hk IS NULL OR b.hk IS NULL OR a.record_hash <> b.record_hash"""))
def cdc_snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change feed of the customer dimension between two points in time."""
    log = silver.customer(spark, sf_dir)

    def at(day: str) -> DataFrame:
        return versions.current_rows(log.filter(F.col("effective_ts") < F.lit(day).cast("timestamp_ntz")), "csn")

    return cdc.snapshot_diff(at("2000-01-15"), at("2000-02-15"), ["hk"],
                             ["customer_name", "country", "src_customer_id", "source_system"]).select(
        "hk", "customer_name", "country", "change_type")


@query("cursor_incremental", """
SELECT o_orderkey, o_custkey, o_orderdate::DATE AS cursor_date FROM orders
WHERE o_orderdate > TIMESTAMP '2000-06-30 00:00:00'""")
def cursor_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cdc.since_cursor(table(spark, sf_dir, "orders"), "o_orderdate", "2000-06-30 00:00:00")
    return rows.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("cursor_date"))


@query("insert_only_audit", with_parts(CUSTOMERS + """,
was AS (SELECT strftime(effective_ts, '%Y-%m') AS batch, hk, csn, country,
               row_number() OVER (PARTITION BY strftime(effective_ts, '%Y-%m') ORDER BY hk, csn) AS up,
               row_number() OVER (PARTITION BY strftime(effective_ts, '%Y-%m') ORDER BY hk DESC, csn DESC) AS down FROM cus),
late AS (SELECT batch, hk, csn, CASE WHEN batch = '2000-02' AND down = 1 THEN 'zz' ELSE country END AS country FROM was
         WHERE NOT (batch = '2000-02' AND up = 1)
         UNION ALL SELECT batch, hk, csn + 1000, country FROM was WHERE batch = '2000-01' AND up = 1)""", """
SELECT batch, count(was.hk) AS rows, count(*) FILTER (late.hk IS NULL) AS lost,
       count(*) FILTER (was.hk IS NOT NULL AND late.hk IS NOT NULL AND was.country IS DISTINCT FROM late.country) AS changed,
       count(*) FILTER (was.hk IS NULL) AS added,
       count(*) FILTER (was.hk IS NULL OR late.hk IS NULL OR was.country IS DISTINCT FROM late.country) = 0 AS insert_only
FROM was FULL JOIN late USING (batch, hk, csn) GROUP BY 1"""))
def insert_only_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer log against a later state of it, in which one row was lost, one changed and one slipped into an old batch."""
    log = staged(silver.customer(spark, sf_dir).select(F.date_format("effective_ts", "yyyy-MM").alias("batch"), "hk", "csn", "country"), "customer_log")
    ends = log.groupBy("batch").agg(F.min(F.struct("hk", "csn")).alias("first"), F.max(F.struct("hk", "csn")).alias("last"))
    own = F.struct("hk", "csn")
    marked = log.join(ends, "batch").withColumns({"is_first": own == F.col("first"), "is_last": own == F.col("last")})
    later = marked.filter("NOT (batch = '2000-02' AND is_first)").withColumn("country", F.expr("CASE WHEN batch = '2000-02' AND is_last THEN 'zz' ELSE country END"))
    slipped = marked.filter("batch = '2000-01' AND is_first").withColumn("csn", F.col("csn") + 1000)
    after = staged(later.unionByName(slipped).select(*log.columns), "customer_log_later")
    return fingerprints.audit(log, after, "batch", ["hk", "csn"], ["hk", "csn", "country"])


# ---------------------------------------------------------------- star schema

@query("fact_sales_orders", with_parts(GOLD, """
SELECT order_hk, customer_hk, source_system, order_date, CAST(order_amount_usd AS DOUBLE) AS order_amount_usd,
       currency_code FROM fact"""))
def fact_sales_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact_sales_orders(spark, sf_dir).withColumn("order_amount_usd", num("order_amount_usd"))


@query("fact_orphan_keys", with_parts(GOLD, """
SELECT hk AS order_hk, src_customer_id, source_system FROM cur
WHERE NOT EXISTS (SELECT 1 FROM dim WHERE dim.src_customer_id = cur.src_customer_id
                                      AND dim.source_system = cur.source_system)"""))
def fact_orphan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current orders whose customer is not in the dimension."""
    orders, dim = silver.orders_current(spark, sf_dir), gold.dim_customer(spark, sf_dir)
    return orders.join(dim.select("src_customer_id", "source_system"), ["src_customer_id", "source_system"],
                       "left_anti").select(F.col("hk").alias("order_hk"), "src_customer_id", "source_system")


@query("expect_warn_counts", with_parts(GOLD, """
SELECT 'fk_customer' AS rule, count(*) AS total, count(*) FILTER (customer_hk IS NULL) AS failed FROM fact
UNION ALL SELECT 'known_currency', count(*), count(*) FILTER (currency_code NOT IN ('USD','EUR','GBP','CAD')) FROM fact"""))
def expect_warn_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {**gold.FACT_RULES, "known_currency": "currency_code IN ('USD','EUR','GBP','CAD')"}
    return expectations.violation_counts(gold.fact_sales_orders(spark, sf_dir), rules)


@query("fact_clustered_layout", with_parts(GOLD, """
SELECT year(order_date) AS order_year, count(*) AS orders, CAST(sum(order_amount_usd) AS DOUBLE) AS revenue_usd
FROM fact WHERE order_date >= DATE '1998-01-01' AND order_date < DATE '2000-01-01' GROUP BY 1"""))
def fact_clustered_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the fact clustered by (order_date, customer_hk), then read a date range back."""
    stored = write_clustered(gold.fact_sales_orders(spark, sf_dir), shared_dir(spark, "fact"),
                             ["order_date", "customer_hk"])
    rows = stored.filter((F.col("order_date") >= F.lit("1998-01-01").cast("date"))
                         & (F.col("order_date") < F.lit("2000-01-01").cast("date")))
    return rows.groupBy(F.year("order_date").cast("long").alias("order_year")).agg(
        F.count("*").alias("orders"), F.sum("order_amount_usd").cast("double").alias("revenue_usd"))


@query("fact_curve_layout", with_parts(GOLD + """,
pick AS (SELECT min(customer_hk) AS lo, substr(min(customer_hk), 1, 2) || 'zz' AS hi FROM fact)""", """
SELECT 'order_date' AS filtered_by, count(*) AS orders, CAST(sum(order_amount_usd) AS DOUBLE) AS revenue_usd
FROM fact WHERE order_date >= DATE '1998-01-01' AND order_date < DATE '1998-04-01'
UNION ALL SELECT 'customer_hk', count(*), CAST(sum(order_amount_usd) AS DOUBLE) FROM fact, pick WHERE customer_hk >= lo AND customer_hk < hi
UNION ALL SELECT 'customer_hk IS NULL', count(*), CAST(sum(order_amount_usd) AS DOUBLE) FROM fact WHERE customer_hk IS NULL"""))
def fact_curve_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the fact along the curve over (order_date, customer_hk), then read it back by either column alone."""
    fact = staged(gold.fact_sales_orders(spark, sf_dir), "fact")
    stored = layout.write_curve(fact, shared_dir(spark, "fact-curve"), ["order_date", "customer_hk"])
    low = stored.agg(F.min("customer_hk").alias("lo")).first()["lo"] or ""
    filters = {
        "order_date": F.col("order_date").between(F.lit("1998-01-01").cast("date"), F.lit("1998-03-31").cast("date")),
        "customer_hk": (F.col("customer_hk") >= low) & (F.col("customer_hk") < low[:2] + "zz"),
        "customer_hk IS NULL": F.col("customer_hk").isNull(),
    }
    parts = [stored.filter(kept).agg(F.count("*").alias("orders"), F.sum("order_amount_usd").cast("double").alias("revenue_usd")).select(
        F.lit(name).alias("filtered_by"), "orders", "revenue_usd") for name, kept in filters.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("monthly_region_revenue", """
SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m') AS order_month, r_name AS region,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue, count(*) AS orders
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""")
def monthly_region_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders fold to (customer, month) before they meet the customer table: a hot customer
    reaches the join as one row per month."""
    per_customer = table(spark, sf_dir, "orders").groupBy(
        F.col("o_custkey").alias("c_custkey"), F.date_format("o_orderdate", "yyyy-MM").alias("order_month")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("revenue"), F.count("*").alias("orders"))
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    placed = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").join(
        nations.select("n_nationkey", "r_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    return per_customer.join(placed, "c_custkey").groupBy("order_month", F.col("r_name").alias("region")).agg(
        F.sum("revenue").cast("double").alias("revenue"), F.sum("orders").alias("orders"))


# ---------------------------------------------------------------- metric view

def _metric(spark: SparkSession, sf_dir: str, measures: list[str], by: list[str]) -> DataFrame:
    return _rounded(SALES_METRICS.query(gold.fact_sales_orders(spark, sf_dir), measures, by, _kept_cells))


def _kept_cells(cells: DataFrame) -> DataFrame:
    return staged(cells, "cells")


def _rounded(out: DataFrame) -> DataFrame:
    rounded = {c: F.round(c, 4).cast("double") for c in ("avg_order_value",) if c in out.columns}
    if "revenue_usd" in out.columns:
        rounded["revenue_usd"] = F.col("revenue_usd").cast("double")
    return out.withColumns(rounded)


_MEASURES = """CAST(sum(order_amount_usd) AS DOUBLE) AS revenue_usd, count(DISTINCT order_hk) AS order_count,
       CAST((2 * sum(CAST(order_amount_usd * 10000 AS BIGINT)) + count(DISTINCT order_hk))
            // (2 * count(DISTINCT order_hk)) AS DOUBLE) / 10000.0::DOUBLE AS avg_order_value,
       count(DISTINCT customer_hk) AS active_customers"""


@query("metric_by_day_system", with_parts(GOLD, f"""
SELECT order_date, source_system, {_MEASURES} FROM fact WHERE order_amount_usd IS NOT NULL GROUP BY 1, 2"""))
def metric_by_day_system(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metric(spark, sf_dir, ["sales", "order volume", "aov", "active_customers"], ["order_date", "erp"])


@query("metric_by_customer", with_parts(GOLD, f"""
SELECT customer_hk AS customer, {_MEASURES} FROM fact WHERE order_amount_usd IS NOT NULL GROUP BY 1"""))
def metric_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metric(spark, sf_dir, ["revenue_usd", "order_count", "avg_order_value", "active_customers"], ["customer"])


@query("metric_total", with_parts(GOLD, f"""
SELECT {_MEASURES} FROM fact WHERE order_amount_usd IS NOT NULL"""))
def metric_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metric(spark, sf_dir, ["revenue_usd", "order_count", "avg_order_value", "active_customers"], [])


_CUTS = {"order_date,source_system": "order_date, source_system", "source_system,customer": "source_system, customer_hk", "source_system": "source_system", "": ""}


def _cut_sql(name: str, columns: str) -> str:
    dims = [(d if d in columns else "NULL") + f" AS {a}" for d, a in (("order_date", "order_date"), ("source_system", "source_system"), ("customer_hk", "customer"))]
    return f"SELECT '{name}' AS cut, {', '.join(dims)}, {_MEASURES} FROM fact WHERE order_amount_usd IS NOT NULL" + (f" GROUP BY {columns}" if columns else "")


@query("metric_lattice", with_parts(GOLD, " UNION ALL ".join(_cut_sql(*c) for c in _CUTS.items())))
def metric_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four cuts of the metric view from one pass over the fact."""
    cuts = [[d for d in name.split(",") if d] for name in _CUTS]
    return _rounded(SALES_METRICS.lattice(
        gold.fact_sales_orders(spark, sf_dir), ["revenue_usd", "order_count", "avg_order_value", "active_customers"], cuts, _kept_cells))


# ---------------------------------------------------------------- policies

@query("row_filter_region", with_parts(GOLD, """
SELECT order_hk, source_system, order_date, CAST(order_amount_usd AS DOUBLE) AS order_amount_usd
FROM fact WHERE source_system IN ('D365', 'JDE', 'EBS')"""))
def row_filter_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product view as an analyst for the Americas sees it: the filter sits on the base table."""
    visible = policy.filter_rows(gold.fact_sales_orders(spark, sf_dir), ["sales_analyst_americas"])
    return products.sales_orders(visible).select("order_hk", "source_system", "order_date", num("order_amount_usd"))


@query("metric_region_policy", with_parts(GOLD, f"""
SELECT source_system, {_MEASURES} FROM fact
WHERE order_amount_usd IS NOT NULL AND source_system IN ('SAP', 'D365') GROUP BY 1"""))
def metric_region_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metric view over the filtered fact: a regional analyst sees regional metrics only."""
    visible = policy.filter_rows(gold.fact_sales_orders(spark, sf_dir), ["sales_analyst_europe"])
    return _rounded(SALES_METRICS.query(
        visible, ["revenue_usd", "order_count", "avg_order_value", "active_customers"], ["source_system"], _kept_cells))


@query("row_filter_sql_function", with_parts(GOLD, """
SELECT source_system, count(*) AS visible FROM fact WHERE source_system IN ('D365', 'SAP', 'QAD') GROUP BY 1"""))
def row_filter_sql_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same policy as a SQL function, for two regional roles at once."""
    policy.register_sql_functions(spark)
    visible = gold.fact_sales_orders(spark, sf_dir).filter(
        F.expr("region_filter(source_system, array('sales_analyst_europe', 'sales_analyst_emea'))"))
    return visible.groupBy("source_system").agg(F.count("*").alias("visible"))


@query("mask_customer_name", with_parts(CUSTOMERS, """
SELECT customer_hk, left(customer_name, 2) || '*****' AS customer_name, customer_name AS steward_name FROM dim"""))
def mask_customer_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("customer_name")
    return gold.dim_customer(spark, sf_dir).select(
        "customer_hk", policy.mask_name(["sales_analyst_emea"], name).alias("customer_name"),
        policy.mask_name(["data_steward"], name).alias("steward_name"))


# Columns tagged as personal data.
PII_TAGS = [("dim_customer", "customer_name", "pii", "name"), ("dim_customer", "src_customer_id", "pii", "identifier")]
TAG_SCHEMA = "table_name string; column_name string; tag_name string; tag_value string"


@query("mask_by_tag", with_parts(CUSTOMERS, """
SELECT customer_hk, left(src_customer_id, 2) || '*****' AS src_customer_id,
       left(customer_name, 2) || '*****' AS customer_name, country, source_system FROM dim"""))
def mask_by_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = seeds.inline(spark, PII_TAGS, TAG_SCHEMA)
    return policy.mask_tagged(gold.dim_customer(spark, sf_dir), "dim_customer", tags, ["exec_readonly"])


@query("mask_variants", """
SELECT c_custkey, sha256(c_name) AS ml_name, CASE WHEN c_name IS NOT NULL THEN '***-MASKED-***' END AS other_name,
       '****@' || lower(c_mktsegment) || '.example' AS other_email, CAST(-1 AS DOUBLE) AS other_balance,
       c_acctbal AS admin_balance
FROM customer""")
def mask_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("c_name")
    email = F.concat(F.lower(F.regexp_replace(name, "#", ".")), F.lit("@"), F.lower("c_mktsegment"), F.lit(".example"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", policy.mask_pii_text("ml_engineer", name).alias("ml_name"),
        policy.mask_pii_text("reader", name).alias("other_name"), policy.mask_email("reader", email).alias("other_email"),
        policy.mask_amount("reader", F.col("c_acctbal")).alias("other_balance"),
        policy.mask_amount("admin", F.col("c_acctbal")).alias("admin_balance"))


# ---------------------------------------------------------------- products

@query("product_sales_orders", with_parts(GOLD, """
SELECT order_hk, customer_hk, source_system, order_date, CAST(order_amount_usd AS DOUBLE) AS order_amount_usd FROM fact"""))
def product_sales_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    publish_view(products.sales_orders(gold.fact_sales_orders(spark, sf_dir)), "v_sales_orders")
    return spark.table("v_sales_orders").withColumn("order_amount_usd", num("order_amount_usd"))


_FEATURES = f"""
feat AS (
  SELECT customer_hk, CAST(sum(order_amount_usd) AS DOUBLE) AS ltv_usd, count(DISTINCT order_hk) AS order_count_all,
         count(DISTINCT CASE WHEN order_date >= DATE '{AS_OF}' - 365 THEN order_hk END) AS order_count_365d,
         max(order_date) AS last_order_date,
         CAST(date_diff('day', max(order_date), DATE '{AS_OF}') AS INTEGER) AS days_since_last_order
  FROM fact WHERE order_date < DATE '{AS_OF}' AND customer_hk IS NOT NULL GROUP BY 1)"""


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.customer_features(gold.fact_sales_orders(spark, sf_dir), AS_OF)


@query("product_customer_360", with_parts(GOLD + "," + _FEATURES, """
SELECT dim.customer_hk, customer_name, country, ltv_usd, order_count_all, last_order_date
FROM dim LEFT JOIN feat USING (customer_hk)"""))
def product_customer_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = products.customer_360(gold.dim_customer(spark, sf_dir), _features(spark, sf_dir))
    return wide.select("customer_hk", "customer_name", "country", num("ltv_usd"), "order_count_all", "last_order_date")


@query("product_discovery", """
SELECT 'doc_' || CAST(d.doc_id AS VARCHAR) AS entry, source AS comment, lang AS domain_hint,
       CAST(l.quality AS VARCHAR) AS quality
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def product_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog entries left-joined to one tag: documents as entries, their labels as tags."""
    entry = F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("entry")
    entries = table(spark, sf_dir, "documents").select(entry, F.col("source").alias("comment"), F.col("lang").alias("domain_hint"))
    tags = table(spark, sf_dir, "labels").select(
        entry, F.explode(F.create_map(F.lit("quality"), F.col("quality").cast("string"), F.lit("toxic"),
                                      F.col("toxic").cast("string"))).alias("tag_name", "tag_value"))
    return products.discover(entries, tags, "quality")


@query("product_search", """
SELECT p_partkey, p_name, p_type FROM part WHERE contains(lower(concat(p_name, p_type)), 'bolt')""")
def product_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.search_catalog(table(spark, sf_dir, "part"), "Bolt", ["p_name", "p_type"]).select(
        "p_partkey", "p_name", "p_type")


CONTRACT = [("order_hk", "string", False), ("customer_hk", "string", False), ("source_system", "string", False),
            ("order_date", "timestamp", False), ("order_amount_usd", "decimal(20,4)", False), ("margin_usd", "double", True)]


@query("contract_conformity", with_parts(GOLD, """
SELECT * FROM (
  SELECT 'order_hk' AS column_name, 'string' AS expected_type, 'string' AS actual_type, FALSE AS nullable,
         count(*) FILTER (order_hk IS NULL) AS nulls, count(*) AS view_rows, 'same' AS change, count(*) = count(order_hk) AS conforms FROM fact
  UNION ALL SELECT 'customer_hk', 'string', 'string', FALSE, count(*) FILTER (customer_hk IS NULL), count(*), 'same', count(*) = count(customer_hk) FROM fact
  UNION ALL SELECT 'source_system', 'string', 'string', FALSE, 0, count(*), 'same', TRUE FROM fact
  UNION ALL SELECT 'order_date', 'timestamp', 'date', FALSE, 0, count(*), 'type_changed', FALSE FROM fact
  UNION ALL SELECT 'order_amount_usd', 'decimal(20,4)', 'decimal(20,4)', FALSE, 0, count(*), 'same', TRUE FROM fact
  UNION ALL SELECT 'margin_usd', 'double', NULL, TRUE, NULL, count(*), 'dropped', FALSE FROM fact)"""))
def contract_conformity(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = products.sales_orders(gold.fact_sales_orders(spark, sf_dir))
    return products.contract_conformity(view, CONTRACT)


# ---------------------------------------------------------------- features

@query("customer_features", with_parts(GOLD + "," + _FEATURES, "SELECT * FROM feat"))
def customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir).drop("feature_ts").withColumn("ltv_usd", num("ltv_usd"))


@query("features_windowed", with_parts(GOLD + f""",
w AS (
  SELECT customer_hk,
         CAST(sum(CASE WHEN order_date >= DATE '{AS_OF}' - 7 THEN order_amount_usd ELSE 0 END) AS DOUBLE) AS rev_l7d_usd,
         CAST(sum(CASE WHEN order_date >= DATE '{AS_OF}' - 30 THEN order_amount_usd ELSE 0 END) AS DOUBLE) AS rev_l30d_usd,
         CAST(sum(CASE WHEN order_date >= DATE '{AS_OF}' - 90 THEN order_amount_usd ELSE 0 END) AS DOUBLE) AS rev_l90d_usd,
         CAST(sum(CASE WHEN order_date >= DATE '{AS_OF}' - 365 THEN order_amount_usd ELSE 0 END) AS DOUBLE) AS rev_l365d_usd,
         count(*) FILTER (order_date >= DATE '{AS_OF}' - 90) AS order_count_l90,
         CAST(date_diff('day', max(order_date), DATE '{AS_OF}') AS INTEGER) AS days_since_last_order
  FROM fact WHERE order_date < DATE '{AS_OF}' AND customer_hk IS NOT NULL GROUP BY 1)""", """
SELECT *, round(least(days_since_last_order / 365.0::DOUBLE, 1.0::DOUBLE) * 0.6::DOUBLE
                + (1.0::DOUBLE / (1.0::DOUBLE + order_count_l90)) * 0.4::DOUBLE, 4) AS churn_risk_score FROM w"""))
def features_windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = features.windowed_features(gold.fact_sales_orders(spark, sf_dir), AS_OF)
    return out.withColumns({c: num(c) for c in out.columns if c.startswith("rev_")})


_VERSIONS = """,
ver AS (
  SELECT customer_hk, date_trunc('quarter', order_date) + INTERVAL 3 MONTH AS feature_ts,
         CAST(sum(order_amount_usd) AS DOUBLE) AS quarter_revenue, count(*) AS quarter_orders
  FROM fact WHERE customer_hk IS NOT NULL GROUP BY 1, 2)"""


def _feature_versions(fact: DataFrame) -> DataFrame:
    """One feature version per customer and quarter, known at the quarter's end."""
    quarter_end = F.add_months(F.trunc("order_date", "quarter"), 3).cast("timestamp_ntz")
    return fact.filter("customer_hk IS NOT NULL").groupBy("customer_hk", quarter_end.alias("feature_ts")).agg(
        F.sum("order_amount_usd").cast("double").alias("quarter_revenue"), F.count("*").alias("quarter_orders"))


@query("training_set_pit", with_parts(GOLD + _VERSIONS, f"""
SELECT f.order_hk, f.customer_hk, f.order_date AS label_date, strftime(v.feature_ts, '{TS}') AS matched_ts,
       v.quarter_revenue, v.quarter_orders
FROM (SELECT * FROM fact WHERE customer_hk IS NOT NULL) f
ASOF LEFT JOIN ver v ON f.customer_hk = v.customer_hk AND CAST(f.order_date AS TIMESTAMP) >= v.feature_ts"""))
def training_set_pit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a label, with the features its customer had at that moment."""
    fact = staged(gold.fact_sales_orders(spark, sf_dir), "fact")
    labels = fact.filter("customer_hk IS NOT NULL").select(
        "order_hk", "customer_hk", F.col("order_date").alias("label_date"),
        F.col("order_date").cast("timestamp_ntz").alias("label_ts"))
    joined = features.asof_join(labels, _feature_versions(fact), "customer_hk", "label_ts", "feature_ts",
                                ["quarter_revenue", "quarter_orders"])
    return joined.select("order_hk", "customer_hk", "label_date", text_ts("matched_ts"), "quarter_revenue", "quarter_orders")


@query("features_online", with_parts(GOLD + _VERSIONS, f"""
SELECT customer_hk, strftime(feature_ts, '{TS}') AS feature_ts, quarter_revenue, quarter_orders FROM ver
QUALIFY row_number() OVER (PARTITION BY customer_hk ORDER BY feature_ts DESC) = 1"""))
def features_online(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = features.online_snapshot(_feature_versions(gold.fact_sales_orders(spark, sf_dir)))
    return latest.select("customer_hk", text_ts("feature_ts"), "quarter_revenue", "quarter_orders")


@query("features_merge", with_parts(GOLD + _VERSIONS, f"""
SELECT customer_hk, strftime(feature_ts, '{TS}') AS feature_ts,
       CASE WHEN feature_ts >= TIMESTAMP '2001-01-01 00:00:00' THEN quarter_revenue + 1 ELSE quarter_revenue END AS quarter_revenue
FROM ver"""))
def features_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge restated versions of the last quarters into the feature table on (key, time)."""
    kept = staged(_feature_versions(gold.fact_sales_orders(spark, sf_dir)), "feature_versions")
    restated = kept.filter(F.col("feature_ts") >= F.lit("2001-01-01").cast("timestamp_ntz")).withColumn(
        "quarter_revenue", F.col("quarter_revenue") + 1)
    return features.merge_versions(kept, restated, ["customer_hk", "feature_ts"]).select(
        "customer_hk", text_ts("feature_ts"), "quarter_revenue")


# ---------------------------------------------------------------- reconciliation and standards

@query("reconcile_tolerance", """
WITH li AS (
  SELECT l_orderkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DECIMAL(28,4)) AS net
  FROM lineitem GROUP BY 1),
j AS (
  SELECT o_orderstatus, coalesce(abs(CAST(o_totalprice AS DECIMAL(18,2)) - net) <= 100000, FALSE) AS matched
  FROM orders FULL OUTER JOIN li ON o_orderkey = l_orderkey)
SELECT o_orderstatus, count(*) AS orders, count(*) FILTER (matched) AS matched,
       round(count(*) FILTER (matched) / count(*), 4) AS match_rate FROM j GROUP BY 1""")
def reconcile_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order header amount against the sum of its lines, within a tolerance."""
    net = F.col("l_extendedprice").cast("decimal(18,2)") * (F.lit(1).cast("decimal(1,0)") - F.col("l_discount").cast("decimal(4,2)"))
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("order_no")).agg(
        F.sum(net.cast("decimal(22,4)")).alias("line_total"))
    heads = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_no"), "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("head_total"))
    out = quality.reconcile(heads, lines, ["order_no"], "head_total", "line_total", "100000")
    return out.groupBy("o_orderstatus").agg(
        F.count("*").alias("orders"), F.count_if("matched").alias("matched"),
        F.round(F.count_if("matched") / F.count("*"), 4).alias("match_rate"))


VARIANTS = [("1-URGENT", "P1"), ("2-HIGH", "P2"), ("3-MEDIUM", "P3")]


@query("code_standardize", """
SELECT o_orderkey, o_orderpriority, CASE o_orderpriority WHEN '1-URGENT' THEN 'P1' WHEN '2-HIGH' THEN 'P2'
       WHEN '3-MEDIUM' THEN 'P3' ELSE o_orderpriority END AS priority_code FROM orders""")
def code_standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    variants = seeds.inline(spark, VARIANTS, "variant string; canonical string")
    return quality.standardize(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"),
                               "o_orderpriority", variants, "priority_code").select(
        "o_orderkey", "o_orderpriority", "priority_code")


# Region name in the geography tables to the sales region that should own it.
REGION_OF = [("EUROPE", "EUROPE"), ("AMERICA", "AMERICAS"), ("AFRICA", "EMEA"), ("MIDDLE EAST", "EMEA"), ("ASIA", "GLOBAL")]


@query("region_consistency", """
WITH c AS (
  SELECT CASE c_custkey % 3 WHEN 0 THEN 'SAP' WHEN 1 THEN 'JDE' ELSE 'QAD' END AS source_system,
         CASE r_name WHEN 'EUROPE' THEN 'EUROPE' WHEN 'AMERICA' THEN 'AMERICAS' WHEN 'AFRICA' THEN 'EMEA'
              WHEN 'MIDDLE EAST' THEN 'EMEA' ELSE 'GLOBAL' END AS sales_region
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT source_system, sales_region, count(*) AS customers,
       CASE source_system WHEN 'SAP' THEN 'EUROPE' WHEN 'JDE' THEN 'AMERICAS' ELSE 'EMEA' END
         IS NOT DISTINCT FROM sales_region AS consistent
FROM c GROUP BY 1, 2""")
def region_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Does the owning system's region agree with the customer's geography?"""
    owner = F.col("c_custkey") % 3
    system = F.when(owner == 0, "SAP").when(owner == 1, "JDE").otherwise("QAD")
    per_nation = table(spark, sf_dir, "customer").groupBy("c_nationkey", system.alias("source_system")).agg(
        F.count("*").alias("customers"))
    geo = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    regions = seeds.inline(spark, REGION_OF, "r_name string; sales_region string")
    expected = seeds.inline(spark, seeds.SYSTEM_REGION, "source_system string; system_region string")
    return (per_nation.join(geo, F.col("c_nationkey") == F.col("n_nationkey")).join(regions, "r_name")
            .join(expected, "source_system", "left").groupBy("source_system", "sales_region", "system_region")
            .agg(F.sum("customers").alias("customers"))
            .select("source_system", "sales_region", "customers",
                    F.col("system_region").eqNullSafe(F.col("sales_region")).alias("consistent")))


# ---------------------------------------------------------------- mappings, lineage, registry over the data

NEW_MAPPINGS = [
    ("m0002b", "bronze.sap.vbak", "NETWR", "sales_order_header", "order_amount", "NETWR * 1.1", 2, "decimal(18,2)"),
    ("m0001b", "bronze.sap.vbak", "KUNNR", "sales_order_header", "src_customer_id", "KUNNR", 2, "string"),
    ("m0099b", "bronze.sap.vbak", "MATNR", "sales_order_header", "material", None, 2, "string"),
]


def _mappings(spark: SparkSession) -> DataFrame:
    """The seed mappings plus a second version for one source."""
    newer = [(i, "silver", src, col, tgt, name, expr, None, v, "2001-01-01 00:00:00", None, "steward", t)
             for i, src, col, tgt, name, expr, v, t in NEW_MAPPINGS]
    return seeds.layer_mappings(spark).unionByName(seeds.inline(spark, newer, seeds.MAPPING_SCHEMA))


@query("mapping_latest", with_parts(ORDERS + ", s AS (SELECT * FROM so_all)", """
SELECT src_table, tgt_column, CAST(version AS INTEGER) AS version, rows, non_null FROM (
  SELECT 'bronze.sap.vbak' AS src_table, 'src_order_id' AS tgt_column, 1 AS version, count(*) AS rows, count(src_order_id) AS non_null FROM s WHERE source_system = 'SAP'
  UNION ALL SELECT 'bronze.sap.vbak', 'src_customer_id', 2, count(*), count(src_customer_id) FROM s WHERE source_system = 'SAP'
  UNION ALL SELECT 'bronze.sap.vbak', 'order_amount', 2, count(*), count(order_amount) FROM s WHERE source_system = 'SAP'
  UNION ALL SELECT 'bronze.sap.vbak', 'currency_code', 1, count(*), count(currency_code) FROM s WHERE source_system = 'SAP'
  UNION ALL SELECT 'bronze.sap.vbak', 'order_date', 1, count(*), count(order_date) FROM s WHERE source_system = 'SAP'
  UNION ALL SELECT 'bronze.sap.vbak', 'source_system', 1, count(*), count(source_system) FROM s WHERE source_system = 'SAP'
  UNION ALL SELECT 'bronze.sap.vbak', 'material', 2, count(*), count(*) FROM s WHERE source_system = 'SAP'
  UNION ALL SELECT 'bronze.jde.f4201', 'src_order_id', 1, count(*), count(src_order_id) FROM s WHERE source_system = 'JDE'
  UNION ALL SELECT 'bronze.jde.f4201', 'src_customer_id', 1, count(*), count(src_customer_id) FROM s WHERE source_system = 'JDE'
  UNION ALL SELECT 'bronze.jde.f4201', 'order_amount', 1, count(*), count(order_amount) FROM s WHERE source_system = 'JDE'
  UNION ALL SELECT 'bronze.jde.f4201', 'currency_code', 1, count(*), count(currency_code) FROM s WHERE source_system = 'JDE'
  UNION ALL SELECT 'bronze.jde.f4201', 'order_date', 1, count(*), count(order_date) FROM s WHERE source_system = 'JDE'
  UNION ALL SELECT 'bronze.jde.f4201', 'source_system', 1, count(*), count(source_system) FROM s WHERE source_system = 'JDE'
  UNION ALL SELECT 'bronze.qad.so_mstr', 'src_order_id', 1, count(*), count(src_order_id) FROM s WHERE source_system = 'QAD'
  UNION ALL SELECT 'bronze.qad.so_mstr', 'src_customer_id', 1, count(*), count(src_customer_id) FROM s WHERE source_system = 'QAD'
  UNION ALL SELECT 'bronze.qad.so_mstr', 'order_amount', 1, count(*), count(order_amount) FROM s WHERE source_system = 'QAD'
  UNION ALL SELECT 'bronze.qad.so_mstr', 'currency_code', 1, count(*), count(currency_code) FROM s WHERE source_system = 'QAD'
  UNION ALL SELECT 'bronze.qad.so_mstr', 'order_date', 1, count(*), count(order_date) FROM s WHERE source_system = 'QAD'
  UNION ALL SELECT 'bronze.qad.so_mstr', 'source_system', 1, count(*), count(source_system) FROM s WHERE source_system = 'QAD')"""))
def mapping_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapping version in force per target column, with how many values it yields."""
    maps = _mappings(spark)
    sources = feeds.order_feeds(spark, sf_dir)
    profile = None
    for src, cols in mapping.load_projections(maps, "sales_order_header"):
        part = lineage.column_profile(mapping.project(sources[src], cols), src)
        profile = part if profile is None else profile.unionByName(part)
    chosen = mapping.latest_mappings(maps, "silver", "sales_order_header").select(
        "src_table", "tgt_column", "version")
    seen = profile.select(F.col("table_name").alias("src_table"), F.col("column_name").alias("tgt_column"), "rows", "non_null")
    return chosen.join(seen, ["src_table", "tgt_column"])


@query("mapping_diff", with_parts(CHANGES, """
SELECT 'bronze.sap.vbak' AS src_table, 'order_amount' AS tgt_column, 'changed' AS change, count(*) AS rows,
       count(*) FILTER (CAST(amount * 1.1 AS DECIMAL(18,2)) IS DISTINCT FROM amount) AS rows_changed
FROM chg WHERE owner = 0
UNION ALL
SELECT 'bronze.sap.vbak', 'src_customer_id', 'changed', count(*), 0 FROM chg WHERE owner = 0
UNION ALL
SELECT 'bronze.sap.vbak', 'material', 'added', count(*), count(*) FROM chg WHERE owner = 0"""))
def mapping_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a new mapping version changes: the definition diff, and how many values differ."""
    sources = feeds.order_feeds(spark, sf_dir)
    maps = _mappings(spark)
    # The newer version carries changed rows only, so columns it does not mention stand.
    touched = maps.filter("version = 2").select("src_table", "tgt_column")
    rows = mapping.bounded_rows(mapping.diff_versions(maps.join(touched, ["src_table", "tgt_column"], "left_semi"), 1, 2))
    impact = None
    for src in sorted({r["src_table"] for r in rows}):
        mine = [r for r in rows if r["src_table"] == src]

        def value(definition):
            if definition is None:
                return F.lit(None)
            return F.expr(definition["transform_expr"] or definition["src_column"]).cast(definition["tgt_type"])

        counts = sources[src].agg(F.count(F.lit(1)).alias("rows"), *[
            F.count_if(~value(r["old_def"]).eqNullSafe(value(r["new_def"]))).alias(f"_d{i}") for i, r in enumerate(mine)])
        part = counts.select("rows", F.inline(F.array(*[
            F.struct(F.lit(src).alias("src_table"), F.lit(r["tgt_column"]).alias("tgt_column"),
                     F.lit(r["change"]).alias("change"), F.col(f"_d{i}").alias("rows_changed"))
            for i, r in enumerate(mine)])))
        impact = part if impact is None else impact.unionByName(part)
    return impact


_FLOW = """
cnt AS (
  SELECT 'bronze.sap.vbak' AS t, count(*) FILTER (owner = 0) AS n FROM chg
  UNION ALL SELECT 'bronze.jde.f4201', count(*) FILTER (owner = 1) FROM chg
  UNION ALL SELECT 'bronze.qad.so_mstr', count(*) FILTER (owner = 2) FROM chg
  UNION ALL SELECT 'bronze.sap.kna1', count(*) FILTER (cowner = 0) FROM cchg
  UNION ALL SELECT 'bronze.jde.f0101', count(*) FILTER (cowner = 1) FROM cchg)"""


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows landed per Bronze table; two aggregates over the change logs."""
    orders = _changes(spark, sf_dir).groupBy("owner").agg(F.count("*").alias("n"))
    customers = feeds.customer_changes(spark, sf_dir).groupBy("owner").agg(F.count("*").alias("n"))
    names = {0: ("bronze.sap.vbak", "bronze.sap.kna1"), 1: ("bronze.jde.f4201", "bronze.jde.f0101"),
             2: ("bronze.qad.so_mstr", None)}

    def label(i: int) -> Column:
        out = F.lit(None).cast("string")
        for owner, pair in names.items():
            if pair[i]:
                out = F.when(F.col("owner") == owner, pair[i]).otherwise(out)
        return out

    return orders.select(label(0).alias("table_name"), "n").unionByName(
        customers.select(label(1).alias("table_name"), "n")).filter("table_name IS NOT NULL")


def _all_edges(spark: SparkSession) -> DataFrame:
    own = mapping.edges(seeds.layer_mappings(spark)).select("src_table", "src_column", "tgt_table", "tgt_column")
    gold_rows = [(s, c, f"gold.{t}", g) for s, c, t, g in seeds.GOLD_EDGES]
    return own.unionByName(seeds.inline(spark, gold_rows, "src_table string; src_column string; tgt_table string; tgt_column string"))


@query("lineage_edges", with_parts(GOLD + "," + _FLOW, """
SELECT e.src_table, e.tgt_table, e.edges, cnt.n AS rows FROM (VALUES
  ('bronze.sap.vbak', 'silver.sales_order_header', CAST(6 AS BIGINT)), ('bronze.jde.f4201', 'silver.sales_order_header', 6),
  ('bronze.qad.so_mstr', 'silver.sales_order_header', 6), ('bronze.sap.kna1', 'silver.customer', 4),
  ('bronze.jde.f0101', 'silver.customer', 4)) e(src_table, tgt_table, edges) JOIN cnt ON cnt.t = e.src_table"""))
def lineage_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapping edges per source and target table, with the rows that flowed along them."""
    per_table = mapping.edges(seeds.layer_mappings(spark)).groupBy("src_table", "tgt_table").agg(F.count("*").alias("edges"))
    landed = _landed(spark, sf_dir).select(F.col("table_name").alias("src_table"), F.col("n").alias("rows"))
    return per_table.join(landed, "src_table")


@query("lineage_downstream", with_parts(GOLD + "," + _FLOW, """
SELECT d.table_name, d.depth, CASE d.table_name
         WHEN 'silver.sales_order_header' THEN (SELECT count(*) FROM sil)
         WHEN 'gold.fact_sales_orders' THEN (SELECT count(*) FROM fact)
         WHEN 'gold.agg_sales_daily' THEN (SELECT count(*) FROM (SELECT DISTINCT order_date, source_system FROM cur))
         WHEN 'gold.customer_features' THEN (SELECT count(DISTINCT customer_hk) FROM fact) END AS rows
FROM (VALUES ('silver.sales_order_header', 1), ('gold.fact_sales_orders', 2), ('gold.agg_sales_daily', 3),
             ('gold.customer_features', 3)) d(table_name, depth)"""))
def lineage_downstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blast radius of one source: every dependent table, its distance, and its current size."""
    reach = lineage.downstream(_all_edges(spark), "bronze.sap.vbak")
    orders = staged(silver.sales_order_header(spark, sf_dir), "orders")
    fact = staged(gold.as_fact(silver.current_rows(orders, "csn"), gold.dim_customer(spark, sf_dir)), "fact")
    sizes = [("silver.sales_order_header", orders.agg(F.count("*").alias("rows"))),
             ("gold.fact_sales_orders", fact.agg(F.count("*").alias("rows"))),
             ("gold.agg_sales_daily", gold.daily_sales(fact).agg(F.count("*").alias("rows"))),
             ("gold.customer_features", fact.agg(F.countDistinct("customer_hk").alias("rows")))]
    sized = None
    for name, df in sizes:
        part = df.select(F.lit(name).alias("table_name"), "rows")
        sized = part if sized is None else sized.unionByName(part)
    return reach.join(sized, "table_name", "left").withColumn("depth", F.col("depth").cast("int"))


def _column_flow() -> list[tuple[str, str, str, str]]:
    """Expressions of Silver's own columns and of Gold."""
    return [(t, t, c, e) for t, c, e in seeds.SILVER_DERIVED] + [(s, f"gold.{t}", g, c) for s, c, t, g in seeds.GOLD_EDGES]


def _impact_sql(table: str, column: str) -> str:
    """The walk over the same configuration rows, with the columns of an expression found as words of its text."""
    flow = [(s, f"silver.{t}", g, e or c) for s, c, t, g, e, *_ in seeds.MAPPINGS] + _column_flow()
    rows = ", ".join("(" + ", ".join("'" + x.replace("'", "''") + "'" for x in r) + ")" for r in flow)
    return f"""(WITH RECURSIVE m(st, tt, tc, ex) AS (VALUES {rows}),
  words AS (SELECT st, tt, tc, unnest(regexp_extract_all(regexp_replace(ex, '\\x27[^\\x27]*\\x27', ' ', 'g'), '[A-Za-z_][A-Za-z_0-9]*')) AS sc FROM m),
  walk AS (SELECT tt, tc, 1 AS depth FROM words WHERE st = '{table}' AND sc = '{column}'
           UNION SELECT w.tt, w.tc, depth + 1 FROM walk JOIN words w ON w.st = walk.tt AND w.sc = walk.tc WHERE depth < 12)
  SELECT tt AS table_name, tc AS column_name, min(depth) AS depth FROM walk GROUP BY ALL)"""


_SHARED_KEY = ("bronze.jde.f4201", "SHDOCO")


@query("column_impact", with_parts(GOLD, f"""
SELECT w.*, CASE w.table_name || '.' || w.column_name
         WHEN 'silver.sales_order_header.src_order_id' THEN (SELECT count(DISTINCT src_order_id) FROM sil)
         WHEN 'silver.sales_order_header.hk' THEN (SELECT count(DISTINCT hk) FROM sil)
         WHEN 'gold.fact_sales_orders.order_hk' THEN (SELECT count(DISTINCT order_hk) FROM fact) END AS different_values
FROM {_impact_sql(*_SHARED_KEY)} w"""))
def column_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blast radius of one column that only an expression reads: every column made from it, and how many values it has now."""
    sources = {**feeds.order_feeds(spark, sf_dir), **feeds.customer_feeds(spark, sf_dir)}
    orders = staged(silver.sales_order_header(spark, sf_dir), "orders")
    fact = gold.as_fact(silver.current_rows(orders, "csn"), gold.dim_customer(spark, sf_dir))
    sources |= {"silver.sales_order_header": orders, "silver.customer": silver.customer(spark, sf_dir), "gold.fact_sales_orders": fact}
    edges = lineage.column_edges(spark, [*mapping.expressions(seeds.layer_mappings(spark)), *_column_flow()], sources)
    sizes = None
    for name, df, columns in (("silver.sales_order_header", orders, ["src_order_id", "hk"]), ("gold.fact_sales_orders", fact, ["order_hk"])):
        for c in columns:
            part = df.groupBy(c).agg(F.lit(1)).agg(F.count(c).alias("different_values")).select(
                F.lit(name).alias("table_name"), F.lit(c).alias("column_name"), "different_values")
            sizes = part if sizes is None else sizes.unionByName(part)
    return lineage.column_impact(edges, *_SHARED_KEY).join(sizes, ["table_name", "column_name"], "left")


@query("registry_validate", with_parts(CHANGES + "," + CUSTOMERS + "," + _FLOW, """
SELECT r.source_name, r.target_table, TRUE AS pattern_ok, TRUE AS pk_ok, TRUE AS region_ok, TRUE AS target_ok,
       TRUE AS sequence_ok, TRUE AS rules_ok, TRUE AS valid, coalesce(cnt.n, 0) AS landed_rows
FROM (VALUES ('sap_vbak_sales_header', 'bronze.sap.vbak'), ('sap_kna1_customer', 'bronze.sap.kna1'),
  ('jde_f4201_sales_header', 'bronze.jde.f4201'), ('jde_f0101_address_book', 'bronze.jde.f0101'),
  ('ebs_oe_order_headers', 'bronze.ebs.oe_order_headers_all'), ('ebs_ra_customer_trx', 'bronze.ebs.ra_customer_trx_all'),
  ('d365_salesorders', 'bronze.d365.salesorders'), ('qad_so_mstr', 'bronze.qad.so_mstr'),
  ('sfdc_opportunity', 'bronze.sfdc.opportunity'), ('ot_furnace_telemetry', 'bronze.ot.furnace_telemetry'),
  ('ot_caster_history', 'bronze.ot.caster_history'), ('mes_rollmill_orders', 'bronze.mes.rollmill_orders')
  ) r(source_name, target_table) LEFT JOIN cnt ON cnt.t = r.target_table"""))
def registry_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Onboarding checks of every registered source, next to the rows it has landed."""
    checked = registry.validate(registry.registry_frame(spark))
    landed = _landed(spark, sf_dir).select(F.col("table_name").alias("target_table"), "n")
    return checked.join(landed, "target_table", "left").select(
        "source_name", "target_table", "pattern_ok", "pk_ok", "region_ok", "target_ok", "sequence_ok", "rules_ok",
        "valid", F.coalesce("n", F.lit(0)).alias("landed_rows"))


@query("schema_drift", with_parts(CHANGES + "," + CUSTOMERS, """
SELECT 'bronze.sap.vbak' AS src_table, 'MATNR' AS src_column, count(*) AS non_null, 'unmapped' AS drift FROM chg WHERE owner = 0
UNION ALL SELECT 'bronze.jde.f4201', 'SHLITM', count(*), 'unmapped' FROM chg WHERE owner = 1
UNION ALL SELECT 'bronze.qad.so_mstr', 'so_part', count(*), 'unmapped' FROM chg WHERE owner = 2
UNION ALL SELECT 'bronze.qad.so_mstr', 'so_domain', count(*), 'unmapped' FROM chg WHERE owner = 2
UNION ALL SELECT 'bronze.sap.kna1', 'LAND2', NULL, 'missing'"""))
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source columns nobody maps, with the values they would bring, and mapped columns that are gone."""
    sources = {**feeds.order_feeds(spark, sf_dir), **feeds.customer_feeds(spark, sf_dir)}
    profile = None
    for name, df in sources.items():
        part = lineage.column_profile(df.drop("op_type", "csn", "changed_at"), name)
        profile = part if profile is None else profile.unionByName(part)
    profile = staged(profile, "profile")
    # One mapping reads a column that the source has lost.
    mapped = [*mapping.expressions(seeds.layer_mappings(spark)), ("bronze.sap.kna1", "silver.customer", "region", "upper(LAND2)")]
    return lineage.schema_drift(profile, lineage.column_edges(spark, mapped, sources))


@query("schema_diff", with_parts(GOLD, """
SELECT 'v_sales_orders' AS table_name, 'currency_code' AS column_name, CAST(NULL AS VARCHAR) AS old_type,
       'string' AS new_type, 'added' AS change, FALSE AS breaking, count(currency_code) AS non_null,
       'minor' AS version_bump, TRUE AS notice_ok FROM fact
UNION ALL SELECT 'v_sales_orders', 'order_amount_usd', 'double', 'decimal(20,4)', 'type_changed', TRUE, count(order_amount_usd), 'major', FALSE FROM fact
UNION ALL SELECT 'v_sales_orders', 'region', 'string', NULL, 'dropped', TRUE, NULL, 'major', FALSE"""))
def schema_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published columns against the previous release: breaking changes, version bump, notice kept."""
    old = seeds.inline(spark, [("v_sales_orders", c, t) for c, t in [
        ("order_hk", "string"), ("customer_hk", "string"), ("source_system", "string"), ("order_date", "date"),
        ("order_amount_usd", "double"), ("region", "string")]], "table_name string; column_name string; data_type string")
    new = lineage.column_profile(gold.fact_sales_orders(spark, sf_dir), "v_sales_orders")
    return products.release_terms(lineage.schema_diff(old, new), announced="2001-07-15", effective=AS_OF)
