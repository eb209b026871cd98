"""Shared CTEs of the check SQL: the source feeds and the Silver and Gold tables in plain SQL."""

from __future__ import annotations

FX = """
fx AS (SELECT * FROM (VALUES ('USD', CAST(1.00 AS DECIMAL(10,4))), ('EUR', CAST(1.09 AS DECIMAL(10,4))),
                             ('GBP', CAST(1.27 AS DECIMAL(10,4))), ('CAD', CAST(0.73 AS DECIMAL(10,4)))
                     ) t(currency_code, usd_rate))"""

CHANGES = """
base AS (
  SELECT o_orderkey AS k, o_custkey % 3 AS owner, CASE WHEN o_orderkey % 113 <> 9 THEN o_custkey END AS c,
         CASE WHEN o_orderkey % 97 <> 3
              THEN (['USD','EUR','GBP','CAD','JPY'])[CAST(o_orderkey % 5 + 1 AS INTEGER)] END AS ccy,
         CAST(o_orderdate AS DATE) AS od, o_orderdate AS ots,
         CASE WHEN o_orderkey % 89 = 5 THEN -CAST(o_totalprice AS DECIMAL(18,2))
              ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS amt
  FROM orders),
chg AS (
  SELECT *, CAST(amt AS DECIMAL(18,2)) AS amount, 'I' AS op, 1 AS csn, ots AS at_ts FROM base
  UNION ALL SELECT *, CAST(amt AS DECIMAL(18,2)), 'I', 1, ots FROM base WHERE k % 71 = 2
  UNION ALL SELECT *, CAST(amt + 100 AS DECIMAL(18,2)), 'U', 2, ots + INTERVAL 1 DAY FROM base WHERE k % 5 = 0
  UNION ALL SELECT *, CAST(amt + 100 AS DECIMAL(18,2)), 'D', 3, ots + INTERVAL 2 DAY FROM base WHERE k % 11 = 0
  UNION ALL SELECT *, CAST(amt + 250 AS DECIMAL(18,2)), 'U', 4, ots + INTERVAL 3 DAY FROM base WHERE k % 55 = 0)"""

ORDERS = CHANGES + "," + FX + """,
so_all AS (
  SELECT CASE owner WHEN 0 THEN '00' || CAST(k + 4000000 AS VARCHAR)
                    WHEN 1 THEN '00001-' || CAST(k + 100000 AS VARCHAR) || '-SO'
                    ELSE 'SO' || CAST(k + 700000 AS VARCHAR) END AS src_order_id,
         CASE owner WHEN 0 THEN 'EU' || lpad(CAST(c AS VARCHAR), 12, '0')
                    WHEN 1 THEN CAST(c + 10000 AS VARCHAR)
                    ELSE 'ME' || lpad(CAST(c AS VARCHAR), 12, '0') END AS src_customer_id,
         amount AS order_amount, ccy AS currency_code, od AS order_date,
         CASE owner WHEN 0 THEN 'SAP' WHEN 1 THEN 'JDE' ELSE 'QAD' END AS source_system, csn, at_ts AS effective_ts, op
  FROM chg),
so AS (SELECT * EXCLUDE (op) FROM so_all WHERE op <> 'D'),
raw AS (
  SELECT so.*, sha256(source_system || '|' || src_order_id) AS hk,
         sha256(concat_ws(chr(31), 'currency_code=' || so.currency_code, 'order_amount=' || CAST(order_amount AS VARCHAR),
                'order_date=' || CAST(order_date AS VARCHAR), 'source_system=' || source_system,
                'src_customer_id=' || src_customer_id, 'src_order_id=' || src_order_id)) AS record_hash,
         fx.usd_rate,
         CAST(order_amount * coalesce(fx.usd_rate, CAST(1 AS DECIMAL(10,4))) AS DECIMAL(20,4)) AS order_amount_usd
  FROM so LEFT JOIN fx ON so.currency_code = fx.currency_code),
sil AS (SELECT * FROM raw WHERE hk IS NOT NULL AND order_amount_usd >= 0 AND currency_code IS NOT NULL),
cur AS (SELECT * FROM sil
        QUALIFY row_number() OVER (PARTITION BY hk ORDER BY effective_ts DESC, csn DESC, record_hash) = 1)"""

CUSTOMERS = """
cbase AS (
  SELECT c_custkey AS ck, c_custkey % 3 AS cowner, c_nationkey, c_mktsegment,
         CASE WHEN c_custkey % 53 = 0 THEN 'xx'
              ELSE chr(CAST(65 + c_nationkey % 26 AS INTEGER)) || chr(CAST(65 + (c_nationkey * 7) % 26 AS INTEGER))
         END AS country,
         CASE WHEN c_custkey % 41 <> 7 THEN c_name END AS nm,
         TIMESTAMP '2000-01-01 00:00:00' + to_days(CAST(c_custkey % 28 AS INTEGER)) AS at0
  FROM customer),
cchg AS (
  SELECT *, nm AS name, 'I' AS op, 1 AS csn, at0 AS at_ts FROM cbase
  UNION ALL SELECT *, nm || ' Ltd', 'U', 2, at0 + INTERVAL 30 DAY FROM cbase WHERE ck % 4 = 0
  UNION ALL SELECT *, nm || ' Ltd', 'U', 3, at0 + INTERVAL 60 DAY FROM cbase WHERE ck % 20 = 0),
cmap AS (
  SELECT CASE cowner WHEN 0 THEN 'EU' || lpad(CAST(ck AS VARCHAR), 12, '0') ELSE CAST(ck + 10000 AS VARCHAR) END
           AS src_customer_id,
         name AS customer_name, country, CASE cowner WHEN 0 THEN 'SAP' ELSE 'JDE' END AS source_system,
         csn, at_ts AS effective_ts
  FROM cchg WHERE cowner IN (0, 1)),
cus AS (
  SELECT *, sha256(source_system || '|' || src_customer_id) AS hk,
         sha256(concat_ws(chr(31), 'country=' || country, 'customer_name=' || customer_name,
                'source_system=' || source_system, 'src_customer_id=' || src_customer_id)) AS record_hash
  FROM cmap),
dim AS (
  SELECT hk AS customer_hk, src_customer_id, customer_name, country, source_system FROM cus
  QUALIFY row_number() OVER (PARTITION BY hk ORDER BY effective_ts DESC, csn DESC, record_hash) = 1)"""

GOLD = ORDERS + "," + CUSTOMERS + """,
fact AS (
  SELECT cur.hk AS order_hk, dim.customer_hk, cur.source_system, cur.order_date, cur.order_amount_usd, cur.currency_code
  FROM cur LEFT JOIN dim ON cur.src_customer_id = dim.src_customer_id AND cur.source_system = dim.source_system)"""

TELEMETRY = """
ev AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS grade,
         (['north','south','west'])[CAST(user_id % 3 + 1 AS INTEGER)] AS site,
         'asset' || CAST(user_id AS VARCHAR) AS asset_id,
         CASE event_type WHEN 'view' THEN 'meltshop' WHEN 'click' THEN 'meltshop' WHEN 'error' THEN 'caster'
              WHEN 'purchase' THEN 'rollmill/mes' ELSE 'utilities' END AS area_path,
         CASE event_type WHEN 'view' THEN 'temperature' WHEN 'click' THEN 'power_kw' WHEN 'error' THEN 'mold_level'
              WHEN 'signup' THEN 'flow' END AS tag,
         CASE WHEN event_id % 2 = 0 THEN 'start' ELSE 'complete' END AS mes_event,
         date_trunc('milliseconds', ts) AS ms
  FROM events),
rec AS (
  SELECT *, CASE WHEN grade < 3 THEN 'BAD' WHEN grade < 10 THEN 'UNCERTAIN' ELSE 'GOOD' END AS quality,
         'plant/' || site || '/' || area_path || '/' ||
           CASE WHEN event_type = 'purchase' THEN 'order_' || mes_event ELSE asset_id || '/' || tag END AS topic
  FROM ev),
fur AS (SELECT * FROM rec WHERE area_path = 'meltshop'),
good AS (SELECT * FROM fur WHERE quality IN ('GOOD','UNCERTAIN')),
heat AS (
  SELECT time_bucket(INTERVAL 5 MINUTES, ms) AS window_start, site, asset_id AS asset, tag, avg(value) AS avg_value,
         max(value) AS max_value, count(*) AS samples
  FROM good GROUP BY ALL)"""


def with_parts(parts: str, select: str) -> str:
    return f"WITH {parts.strip()}\n{select.strip()}"


TS = "%Y-%m-%d %H:%M:%S"
