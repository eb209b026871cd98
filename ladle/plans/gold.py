"""Gold: star schema and daily aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.operators.rollup import product
from ladle.operators.versions import current_rows
from ladle.plans import silver

# Fixed value: warn-level expectation of the fact table.
FACT_RULES = {"fk_customer": "customer_hk IS NOT NULL"}


# Published columns of the star schema, their types and where they come from.
CUSTOMER_DIMENSION = (
    ("customer_hk", "string", "hk"), ("src_customer_id", "string", "src_customer_id"), ("customer_name", "string", "customer_name"),
    ("country", "string", "country"), ("source_system", "string", "source_system"))
SALES_FACT = (
    ("order_hk", "string", "hk"), ("customer_hk", "string", "customer_hk"), ("source_system", "string", "source_system"),
    ("order_date", "date", "order_date"), ("order_amount_usd", "decimal(20,4)", "order_amount_usd"), ("currency_code", "string", "currency_code"))
HEAT_FACT = (
    ("heat_hk", "string", "hk"), ("site", "string", "site"), ("asset", "string", "asset"), ("tag", "string", "tag"),
    ("window_start", "timestamp", "window_start"), ("avg_value", "double", "avg_value"), ("max_value", "double", "max_value"))


def as_dimension(customers: DataFrame) -> DataFrame:
    """Latest version per key, named for the star schema."""
    return product(current_rows(customers, "csn"), CUSTOMER_DIMENSION)


def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_dimension(silver.customer(spark, sf_dir))


def as_fact(orders: DataFrame, dim: DataFrame) -> DataFrame:
    """Orders with the key of their customer, NULL where the customer is unknown.

    An equi-join on the natural key without a hint: the dimension grows with the business, so
    Spark broadcasts it only while its measured size is small, and otherwise splits hot
    customers at run time. The hash key itself is not recomputed per order.
    """
    natural = ["src_customer_id", "source_system"]
    return product(orders.join(dim.select("customer_hk", *natural), natural, "left"), SALES_FACT)


def fact_sales_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_fact(silver.orders_current(spark, sf_dir), dim_customer(spark, sf_dir))


def daily_sales(fact: DataFrame) -> DataFrame:
    """Revenue and number of orders per day and system: orders are folded first, so their distinct count is a plain one."""
    day = ["order_date", "source_system"]
    orders = fact.groupBy(*day, "order_hk").agg(F.sum("order_amount_usd").alias("amount"))
    return orders.groupBy(*day).agg(F.sum("amount").alias("revenue_usd"), F.count("order_hk").alias("orders"))


def agg_sales_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension is unique per join key, so the fact's left join neither adds nor drops orders
    and none of its columns are read here: the aggregate takes the current orders directly."""
    orders = silver.orders_current(spark, sf_dir).withColumnRenamed("hk", "order_hk")
    return daily_sales(orders)


def heat_quality(heat: DataFrame) -> DataFrame:
    return product(heat, HEAT_FACT)
