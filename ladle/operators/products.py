"""Data products: published projections, discovery and contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sales_orders(fact: DataFrame) -> DataFrame:
    return fact.select("order_hk", "customer_hk", "source_system", "order_date", "order_amount_usd")


def customer_360(dim: DataFrame, features: DataFrame) -> DataFrame:
    return dim.join(features, "customer_hk", "left")


def profile_text(customers: DataFrame) -> DataFrame:
    """One line of text per customer for semantic search."""
    text = F.concat_ws(
        " ", "customer_name", "country", "source_system",
        F.concat(F.lit("orders "), F.col("order_count_all").cast("string")),
        F.concat(F.lit("last "), F.col("last_order_date").cast("string")))
    return customers.select("customer_hk", text.alias("profile_text"))


def melt_to_margin(heat: DataFrame, sales: DataFrame) -> DataFrame:
    """Plant conditions next to sales at day grain.

    Both sides are aggregated to the day before they meet, so the join is one row to few.
    """
    plant = heat.groupBy(F.col("window_start").cast("date").alias("day"), "site").agg(
        F.sum("samples").alias("samples"), F.max("max_value").alias("peak_value"))
    revenue = sales.groupBy(F.col("order_date").alias("day")).agg(
        F.sum("order_amount_usd").alias("revenue_usd"), F.count("*").alias("orders"))
    return plant.join(revenue, "day", "left")


def discover(entries: DataFrame, tags: DataFrame, tag: str) -> DataFrame:
    """Catalog entries with the value of one tag, NULL where the entry does not carry it."""
    wanted = tags.filter(F.col("tag_name") == tag).select("entry", F.col("tag_value").alias(tag))
    return entries.join(wanted, "entry", "left")


def search_catalog(entries: DataFrame, text: str, columns: list[str]) -> DataFrame:
    """Case-insensitive substring search over the joined columns."""
    return entries.filter(F.lower(F.concat_ws("", *columns)).contains(text.lower()))


# Fixed value: days of notice a breaking change needs.
NOTICE_DAYS = 30


def release_terms(diff: DataFrame, announced: str, effective: str) -> DataFrame:
    """Version bump each schema change asks for, and whether a breaking one was announced in time."""
    days = F.datediff(F.lit(effective).cast("date"), F.lit(announced).cast("date"))
    return diff.withColumns({
        "version_bump": F.when(F.col("breaking"), "major").otherwise("minor"),
        "notice_ok": ~F.col("breaking") | (days >= NOTICE_DAYS),
    })


def contract_conformity(view: DataFrame, contract: list[tuple[str, str, bool]]) -> DataFrame:
    """Promised columns against a published view: present, type equal, and NULLs where none are allowed.

    NULLs of all columns are counted in one aggregate over the view.
    """
    actual = dict(view.dtypes)
    counts = view.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"_n_{c}") for c in actual])
    promised = {name for name, _, _ in contract}
    entries = [
        F.struct(F.lit(name).alias("column_name"), F.lit(dtype).alias("expected_type"),
                 F.lit(actual.get(name)).alias("actual_type"), F.lit(nullable).alias("nullable"),
                 (F.col(f"_n_{name}") if name in actual else F.lit(None).cast("long")).alias("nulls"))
        for name, dtype, nullable in contract
    ] + [
        F.struct(F.lit(name).alias("column_name"), F.lit(None).cast("string").alias("expected_type"),
                 F.lit(dtype).alias("actual_type"), F.lit(True).alias("nullable"), F.col(f"_n_{name}").alias("nulls"))
        for name, dtype in actual.items() if name not in promised
    ]
    change = (F.when(F.col("expected_type").isNull(), "added").when(F.col("actual_type").isNull(), "dropped")
              .when(F.col("expected_type") != F.col("actual_type"), "type_changed").otherwise("same"))
    conforms = change.isin("same", "added") & (F.col("nullable") | (F.coalesce("nulls", F.lit(0)) == 0))
    return counts.select(F.inline(F.array(*entries)), F.col("_rows").alias("view_rows")).withColumns(
        {"change": change, "conforms": conforms})
