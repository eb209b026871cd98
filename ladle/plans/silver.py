"""Silver: conformed, insert-only, hash-keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.operators.expectations import drop_failing
from ladle.operators.mapping import conform
from ladle.operators.versions import current_rows, silver_envelope
from ladle.sources import feeds
from ladle.sources.seeds import fx_rates, layer_mappings

ORDER_COLUMNS = ["src_order_id", "src_customer_id", "order_amount", "currency_code", "order_date", "source_system"]
CUSTOMER_COLUMNS = ["src_customer_id", "customer_name", "country", "source_system"]
FX_AS_OF = "2001-08-01"

# Expectations of the conformed tables.
ORDER_RULES = {"valid_hk": "hk IS NOT NULL", "valid_amount": "order_amount_usd >= 0",
               "valid_currency": "currency_code IS NOT NULL"}
CUSTOMER_RULES = {"valid_hk": "hk IS NOT NULL"}


def to_usd(orders: DataFrame, fx: DataFrame) -> DataFrame:
    """Amount in USD; an unknown currency counts at parity. Rates are keyed by currency.

    Decimal arithmetic is exact, so totals do not depend on row order or partitioning.
    """
    rate = F.coalesce("usd_rate", F.lit(1).cast("decimal(10,4)"))
    return orders.join(fx, "currency_code", "left").withColumn(
        "order_amount_usd", (F.col("order_amount") * rate).cast("decimal(20,4)"))


def conformed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union of the order dialects with hash keys, before currency and expectations.

    Silver reads the change log; deletes live in the Bronze mirror only.
    """
    return _conform_orders(spark, feeds.order_feeds(spark, sf_dir))


def _conform_orders(spark: SparkSession, sources: dict[str, DataFrame]) -> DataFrame:
    mapped = conform(sources, layer_mappings(spark), "sales_order_header", ["op_type", "csn", "changed_at"])
    return silver_envelope(mapped.filter("op_type <> 'D'"), ["src_order_id"], F.col("changed_at"),
                           ORDER_COLUMNS).drop("changed_at", "op_type")


def order_stream(spark: SparkSession, changes: DataFrame) -> DataFrame:
    """The same conformance over a stream of changes: union of streams, stream-static currency join."""
    conformed = _conform_orders(spark, feeds.order_feeds_of(changes))
    return drop_failing(to_usd(conformed, fx_rates(spark, FX_AS_OF)), ORDER_RULES)


def sales_order_header_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_usd(conformed_orders(spark, sf_dir), fx_rates(spark, FX_AS_OF))


def sales_order_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_failing(sales_order_header_raw(spark, sf_dir), ORDER_RULES)


def orders_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_rows(sales_order_header(spark, sf_dir), "csn")


def customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    keep = ["op_type", "csn", "changed_at"]
    mapped = conform(feeds.customer_feeds(spark, sf_dir), layer_mappings(spark), "customer", keep)
    enveloped = silver_envelope(mapped, ["src_customer_id"], F.col("changed_at"), CUSTOMER_COLUMNS)
    return drop_failing(enveloped.drop("changed_at", "op_type"), CUSTOMER_RULES)
