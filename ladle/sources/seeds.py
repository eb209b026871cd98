"""Inline row sources: exchange rates, mappings, rules, products.

Everything in this module is configuration of a fixed, small size.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

# Currency code and its rate to USD.
FX_RATES = [("USD", "1.00"), ("EUR", "1.09"), ("GBP", "1.27"), ("CAD", "0.73")]

# Silver mappings (src_table, src_column, tgt_table, tgt_column, transform_expr, dq_rule),
# with the type each target column is cast to. A NULL expression passes src_column through.
MAPPINGS = [
    ("bronze.sap.vbak", "VBELN", "sales_order_header", "src_order_id", None, "NOT NULL", "string"),
    ("bronze.sap.vbak", "KUNNR", "sales_order_header", "src_customer_id", None, None, "string"),
    ("bronze.sap.vbak", "NETWR", "sales_order_header", "order_amount", None, ">= 0", "decimal(18,2)"),
    ("bronze.sap.vbak", "WAERK", "sales_order_header", "currency_code", None, "NOT NULL", "string"),
    ("bronze.sap.vbak", "ERDAT", "sales_order_header", "order_date", "to_date(ERDAT)", None, "date"),
    ("bronze.sap.vbak", None, "sales_order_header", "source_system", "'SAP'", None, "string"),
    ("bronze.jde.f4201", None, "sales_order_header", "src_order_id",
     "concat_ws('-', SHKCOO, SHDOCO, SHDCTO)", "NOT NULL", "string"),
    ("bronze.jde.f4201", "SHAN8", "sales_order_header", "src_customer_id", None, None, "string"),
    ("bronze.jde.f4201", "SHOTOT", "sales_order_header", "order_amount", "SHOTOT/100", None, "decimal(18,2)"),
    ("bronze.jde.f4201", "SHCRCD", "sales_order_header", "currency_code", None, None, "string"),
    ("bronze.jde.f4201", "SHTRDJ", "sales_order_header", "order_date",
     "date_add(to_date('1900-01-01'), cast(SHTRDJ AS INT) - 36525)", None, "date"),
    ("bronze.jde.f4201", None, "sales_order_header", "source_system", "'JDE'", None, "string"),
    ("bronze.qad.so_mstr", "so_nbr", "sales_order_header", "src_order_id", None, "NOT NULL", "string"),
    ("bronze.qad.so_mstr", "so_cust", "sales_order_header", "src_customer_id", None, None, "string"),
    ("bronze.qad.so_mstr", "so_t_amt", "sales_order_header", "order_amount", None, None, "decimal(18,2)"),
    ("bronze.qad.so_mstr", "so_curr", "sales_order_header", "currency_code", None, None, "string"),
    ("bronze.qad.so_mstr", "so_ord_date", "sales_order_header", "order_date", None, None, "date"),
    ("bronze.qad.so_mstr", None, "sales_order_header", "source_system", "'QAD'", None, "string"),
    ("bronze.sap.kna1", "KUNNR", "customer", "src_customer_id", None, "NOT NULL", "string"),
    ("bronze.sap.kna1", "NAME1", "customer", "customer_name", None, None, "string"),
    ("bronze.sap.kna1", "LAND1", "customer", "country", None, "RLIKE '^[A-Z]{2}$'", "string"),
    ("bronze.sap.kna1", None, "customer", "source_system", "'SAP'", None, "string"),
    ("bronze.jde.f0101", "ABAN8", "customer", "src_customer_id", None, "NOT NULL", "string"),
    ("bronze.jde.f0101", "ABALPH", "customer", "customer_name", None, None, "string"),
    ("bronze.jde.f0101", "ABCTR", "customer", "country", None, None, "string"),
    ("bronze.jde.f0101", None, "customer", "source_system", "'JDE'", None, "string"),
]

# Columns that Silver derives from its own, for lineage only: (table, column, expression).
SILVER_DERIVED = [
    ("silver.sales_order_header", "hk", "sha2(concat_ws('|', source_system, src_order_id), 256)"),
    ("silver.sales_order_header", "order_amount_usd", "order_amount * CASE currency_code WHEN 'USD' THEN 1.0 ELSE 2.0 END"),
    ("silver.customer", "hk", "sha2(concat_ws('|', source_system, src_customer_id), 256)"),
]

# Gold mappings, for lineage only (our own; the Gold layer is code).
GOLD_EDGES = [
    ("silver.sales_order_header", "hk", "fact_sales_orders", "order_hk"),
    ("silver.sales_order_header", "source_system", "fact_sales_orders", "source_system"),
    ("silver.sales_order_header", "order_date", "fact_sales_orders", "order_date"),
    ("silver.sales_order_header", "order_amount_usd", "fact_sales_orders", "order_amount_usd"),
    ("silver.sales_order_header", "currency_code", "fact_sales_orders", "currency_code"),
    ("silver.customer", "hk", "dim_customer", "customer_hk"),
    ("silver.customer", "customer_name", "dim_customer", "customer_name"),
    ("silver.customer", "country", "dim_customer", "country"),
    ("gold.dim_customer", "customer_hk", "fact_sales_orders", "customer_hk"),
    ("gold.fact_sales_orders", "order_amount_usd", "agg_sales_daily", "revenue_usd"),
    ("gold.fact_sales_orders", "order_hk", "agg_sales_daily", "orders"),
    ("gold.fact_sales_orders", "order_amount_usd", "customer_features", "ltv_usd"),
]

# Data-quality rules (table, dimension, rule, threshold). A NULL rule is the
# uniqueness rule on (hk, effective_ts). ``run_at`` is the time of the run.
DQ_RULES = [
    ("silver.sales_order_header", "COMPLETENESS", "src_customer_id IS NOT NULL", 0.99),
    ("silver.sales_order_header", "VALIDITY", "order_amount_usd BETWEEN 0 AND 50000000", 0.999),
    ("silver.sales_order_header", "UNIQUENESS", None, 0.999),
    ("silver.sales_order_header", "TIMELINESS", "effective_ts >= run_at - INTERVAL 1 DAY", 0.95),
    ("silver.customer", "CONSISTENCY", "country RLIKE '^[A-Z]{2}$'", 0.98),
    ("gold.fact_sales_orders", "ACCURACY", "customer_hk IS NOT NULL", 0.99),
]

# Expectation-name token to DAMA dimension, first match wins, else VALIDITY.
DIMENSION_TOKENS = [
    ("pk", "COMPLETENESS"), ("complete", "COMPLETENESS"), ("valid", "VALIDITY"), ("ts", "TIMELINESS"),
    ("timely", "TIMELINESS"), ("uniq", "UNIQUENESS"), ("quality", "ACCURACY"), ("format", "CONSISTENCY"),
]

# Product, domain, freshness target in minutes, availability in percent.
PRODUCTS = [
    ("sales_orders_unified", "sales", 30, 99.5),
    ("customer_360", "sales", 60, 99.5),
    ("melt_to_margin", "operations", 15, 99.0),
]

# Quality thresholds of the product sales_orders_unified.
PRODUCT_THRESHOLDS = [
    ("sales_orders_unified", "COMPLETENESS", 0.99), ("sales_orders_unified", "VALIDITY", 0.999),
    ("sales_orders_unified", "UNIQUENESS", 0.999), ("sales_orders_unified", "TIMELINESS", 0.95),
    ("sales_orders_unified", "CONSISTENCY", 0.98), ("sales_orders_unified", "ACCURACY", 0.99),
]

# Which tables and source flows feed each product (our own wiring of the products above).
PRODUCT_TABLES = [
    ("sales_orders_unified", "silver.sales_order_header"), ("sales_orders_unified", "gold.fact_sales_orders"),
    ("customer_360", "silver.customer"),
]
PRODUCT_FLOWS = [
    ("sales_orders_unified", "sap_vbak_sales_header"), ("customer_360", "sfdc_opportunity"),
    ("melt_to_margin", "ot_furnace_telemetry"), ("melt_to_margin", "ot_caster_history"),
]

# Source system to the region it serves.
SYSTEM_REGION = [
    ("SAP", "EUROPE"), ("JDE", "AMERICAS"), ("EBS", "AMERICAS"), ("D365", "GLOBAL"), ("QAD", "EMEA"),
    ("SALESFORCE", "GLOBAL"), ("LITMUS", "AMERICAS"), ("MES", "AMERICAS"),
]

# Source priority for survivorship, best first.
SOURCE_PRIORITY = ["SAP", "JDE", "QAD"]


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def inline(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A VALUES relation. Catalyst knows its size, so joins to it broadcast by themselves."""
    fields = [f.strip().split(" ", 1) for f in schema.split(";")]
    names = ", ".join(name for name, _ in fields)
    values = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    casts = ", ".join(f"CAST({name} AS {dtype}) AS {name}" for name, dtype in fields)
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({names})")


def fx_rates(spark: SparkSession, as_of: str) -> DataFrame:
    return inline(spark, [(c, r, as_of) for c, r in FX_RATES],
                  "currency_code string; usd_rate decimal(10,4); as_of date")


def layer_mappings(spark: SparkSession, valid_from: str = "1995-01-01 00:00:00") -> DataFrame:
    rows = [(f"m{i:04d}", "silver", *m[:6], 1, valid_from, None, "seed", m[6]) for i, m in enumerate(MAPPINGS)]
    return inline(spark, rows, MAPPING_SCHEMA)


MAPPING_SCHEMA = (
    "mapping_id string; layer string; src_table string; src_column string; tgt_table string; tgt_column string; "
    "transform_expr string; dq_rule string; version int; valid_from timestamp_ntz; valid_to timestamp_ntz; "
    "changed_by string; tgt_type string"
)
