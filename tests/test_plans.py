"""The registered queries: entry contract, plan shape, skew, and a spot check of every query at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from ladle.operators import expectations
from ladle.plans import gold, report_sales, silver
from tools.check import TABLES, compare

ALL = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(request):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    return c


def test_every_check_sql_has_a_query():
    assert set(SQL) <= set(ALL)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ALL))
def test_query_matches_sql(spark, con, sf, name):
    status, note, _ = compare(spark, con, sf, name, ALL[name], SQL.get(name))
    assert status in ("ok", "ROWS"), note


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_daily_sales_reads_four_columns_and_limits_before_the_shuffle(spark, sf):
    plan = executed(gold.agg_sales_daily(spark, sf))
    schemas = {line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema: " in line}
    assert all(s.count(":") == 4 for s in schemas), schemas
    assert plan.count("WindowGroupLimit") == 2
    # Ranking and the distinct count share one shuffle on the key; one more for the daily groups.
    assert plan.count("Exchange hashpartitioning") == 2


def test_daily_sales_equals_the_aggregate_over_the_fact(spark, sf):
    direct = gold.agg_sales_daily(spark, sf)
    via_fact = gold.daily_sales(gold.fact_sales_orders(spark, sf))
    assert direct.exceptAll(via_fact).count() == 0 and via_fact.exceptAll(direct).count() == 0


def test_natural_key_join_equals_hash_key(spark, sf):
    fact = gold.fact_sales_orders(spark, sf)
    dim = gold.dim_customer(spark, sf)
    assert fact.count() == silver.orders_current(spark, sf).count()
    assert fact.filter("customer_hk IS NOT NULL").join(dim, ["customer_hk", "source_system"], "left_anti").count() == 0


def test_hot_customer_is_split_at_run_time(spark):
    """A third of the orders belongs to one customer: the join splits that partition."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        orders = spark.range(0, 60000, 1, 6).selectExpr(
            "sha2(cast(id AS string), 256) AS hk", "if(id % 3 = 0, 'hot', concat('c', id % 997)) AS src_customer_id",
            "'SAP' AS source_system", "current_date() AS order_date", "cast(id AS decimal(20,4)) AS order_amount_usd", "'USD' AS currency_code")
        dim = spark.range(997).selectExpr("sha2(cast(id AS string), 256) AS customer_hk",
                                          "if(id = 0, 'hot', concat('c', id)) AS src_customer_id", "'SAP' AS source_system")
        fact = gold.as_fact(orders, dim)
        rows = fact.collect()
        assert len(rows) == 60000
        assert "skew=true" in fact._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_quarantine_and_good_rows_add_up(spark, sf):
    raw = silver.sales_order_header_raw(spark, sf)
    good, bad = expectations.split(raw, silver.ORDER_RULES)
    assert good.count() + bad.count() == raw.count()
    assert good.count() == silver.sales_order_header(spark, sf).count()


def test_exchange_rates_are_unique(spark):
    fx = silver.fx_rates(spark, silver.FX_AS_OF)
    assert fx.count() == fx.select("currency_code").distinct().count()


def test_money_is_exact(spark, sf):
    assert dict(report_sales.gold.daily_sales(gold.fact_sales_orders(spark, sf)).dtypes)["revenue_usd"].startswith("decimal")
