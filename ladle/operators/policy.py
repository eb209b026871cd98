"""Row filters and column masks, applied where a base view is built so that all views inherit them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Roles that see every row, and the systems each regional role sees.
ALL_ROWS_ROLES = ["data_engineer", "exec_readonly"]
REGION_ROLES = {
    "sales_analyst_europe": ["SAP"],
    "sales_analyst_americas": ["JDE", "EBS"],
    "sales_analyst_emea": ["QAD"],
}
OPEN_SYSTEMS = ["D365"]
STEWARD_ROLE = "data_steward"


def region_predicate(roles: Iterable[str], system: Column) -> Column:
    """Rows the roles may see. An unknown (NULL) system is hidden from regional roles."""
    roles = set(roles)
    if roles & set(ALL_ROWS_ROLES):
        return F.lit(True)
    visible = OPEN_SYSTEMS + [s for role, systems in REGION_ROLES.items() if role in roles for s in systems]
    return F.coalesce(system.isin(visible), F.lit(False))


def filter_rows(df: DataFrame, roles: Iterable[str], system: str = "source_system") -> DataFrame:
    return df.filter(region_predicate(roles, F.col(system)))


def mask_name(roles: Iterable[str], name: Column) -> Column:
    return name if STEWARD_ROLE in set(roles) else F.concat(F.left(name, F.lit(2)), F.lit("*****"))


def mask_tagged(df: DataFrame, table: str, tags: DataFrame, roles: Iterable[str], tag: str = "pii") -> DataFrame:
    """Mask every column of ``table`` that carries ``tag``; the rest passes through.

    Tags are catalog metadata (table_name, column_name, tag_name), read on the driver to build
    the select list; only names of columns this frame has are asked for.
    """
    rows = tags.filter((F.col("table_name") == table) & (F.col("tag_name") == tag)
                       & F.col("column_name").isin(df.columns)).select("column_name").distinct().collect()
    tagged = {r[0] for r in rows}
    return df.select(*[
        mask_name(roles, F.col(c).cast("string")).alias(c) if c in tagged else F.col(c) for c in df.columns])


# Texts and sentinel of the mask variants.
MASKED_TEXT = "***-MASKED-***"
MASKED_LOCAL_PART = "****"
MASKED_AMOUNT = -1


def mask_pii_text(role: str, value: Column) -> Column:
    """Admins see the value, ML engineers a stable token, others nothing."""
    if role == "admin":
        return value
    return F.sha2(value, 256) if role == "ml_engineer" else F.when(value.isNotNull(), F.lit(MASKED_TEXT))


def mask_email(role: str, value: Column) -> Column:
    return value if role == "admin" else F.regexp_replace(value, "^[^@]*@", f"{MASKED_LOCAL_PART}@")


def mask_amount(role: str, value: Column) -> Column:
    return value if role == "admin" else F.lit(MASKED_AMOUNT).cast("double")


def register_sql_functions(spark: SparkSession) -> None:
    """The same policies as SQL functions; roles come from the session variable ``roles``."""
    spark.sql("DECLARE OR REPLACE VARIABLE roles ARRAY<STRING> DEFAULT array()")
    regional = " OR ".join(
        f"(array_contains(roles, '{role}') AND src IN ({', '.join(repr(s) for s in systems)}))"
        for role, systems in REGION_ROLES.items())
    everyone = " OR ".join(f"array_contains(roles, '{r}')" for r in ALL_ROWS_ROLES)
    opened = ", ".join(repr(s) for s in OPEN_SYSTEMS)
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION region_filter(src STRING, roles ARRAY<STRING>) RETURNS BOOLEAN "
        f"RETURN coalesce({everyone} OR {regional} OR src IN ({opened}), false)")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION mask_customer_name(name STRING, roles ARRAY<STRING>) RETURNS STRING "
        f"RETURN CASE WHEN array_contains(roles, '{STEWARD_ROLE}') THEN name ELSE concat(left(name, 2), '*****') END")
