"""Config-driven projection: mapping rows to select lists, and the union of conformed sources."""

from __future__ import annotations

from functools import reduce
from itertools import groupby

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ladle.operators.versions import latest_per_key

# A mapping table is configuration: one row per target column and source. Far above any real estate.
MAX_MAPPING_ROWS = 100_000


def bounded_rows(config: DataFrame) -> list[Row]:
    """Configuration rows on the driver; refuses a frame that is no configuration by its size."""
    rows = config.limit(MAX_MAPPING_ROWS + 1).collect()
    if len(rows) > MAX_MAPPING_ROWS:
        raise ValueError(f"more than {MAX_MAPPING_ROWS} configuration rows")
    return rows


def latest_mappings(mappings: DataFrame, layer: str | None = None, tgt_table: str | None = None) -> DataFrame:
    """Highest open version per (src_table, tgt_column); retired rows are left out first."""
    open_rows = mappings.filter(F.col("valid_to").isNull())
    if layer is not None:
        open_rows = open_rows.filter(F.col("layer") == layer)
    if tgt_table is not None:
        open_rows = open_rows.filter(F.col("tgt_table") == tgt_table)
    return latest_per_key(open_rows, ["src_table", "tgt_column"], [F.col("version").desc(), F.col("mapping_id")])


def load_projections(mappings: DataFrame, tgt_table: str) -> list[tuple[str, list[tuple[str, str, str]]]]:
    """``[(src_table, [(tgt_column, sql_expr, type)])]`` in a stable order.

    Read on the driver, because it decides the shape of the plan; the row count is checked.
    """
    wanted = latest_mappings(mappings, "silver", tgt_table).select(
        "src_table", "tgt_column", F.coalesce("transform_expr", "src_column").alias("expr"), "tgt_type")
    ordered = bounded_rows(wanted.orderBy("src_table", "tgt_column"))
    return [(src, [tuple(r)[1:] for r in rows]) for src, rows in groupby(ordered, key=lambda r: r["src_table"])]


def project(df: DataFrame, columns: list[tuple[str, str, str]], keep: list[str] | None = None) -> DataFrame:
    """Apply one source's mappings. Every target is cast: a union must never widen silently."""
    return df.selectExpr(*[f"cast({expr} AS {dtype}) AS {tgt}" for tgt, expr, dtype in columns], *(keep or []))


def conform(sources: dict[str, DataFrame], mappings: DataFrame, tgt_table: str,
            keep: list[str] | None = None) -> DataFrame:
    """Map every source of ``tgt_table`` and union by name; works on batch and streaming frames."""
    parts = [project(sources[src], cols, keep) for src, cols in load_projections(mappings, tgt_table) if src in sources]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def diff_versions(mappings: DataFrame, old: int, new: int) -> DataFrame:
    """Columns added, removed or changed between two mapping versions."""
    key = ["src_table", "tgt_column"]
    body = F.struct("tgt_table", "src_column", "transform_expr", "tgt_type")
    before = mappings.filter(F.col("version") == old).select(*key, body.alias("old_def"))
    after = mappings.filter(F.col("version") == new).select(*key, body.alias("new_def"))
    change = (
        F.when(F.col("old_def").isNull(), "added")
        .when(F.col("new_def").isNull(), "removed")
        .when(~F.col("old_def").eqNullSafe(F.col("new_def")), "changed")
    )
    return before.join(after, key, "full_outer").withColumn("change", change).filter("change IS NOT NULL")


def edges(mappings: DataFrame) -> DataFrame:
    """Column-level lineage edges of the mappings in force."""
    return latest_mappings(mappings).select(
        "src_table", "src_column", F.concat(F.col("layer"), F.lit("."), F.col("tgt_table")).alias("tgt_table"),
        "tgt_column", "transform_expr", "version")


def expressions(mappings: DataFrame) -> list[tuple[str, str, str, str]]:
    """``(src_table, tgt_table, tgt_column, expression)`` of the mappings in force, for column lineage."""
    wanted = latest_mappings(mappings).select(
        "src_table", F.concat(F.col("layer"), F.lit("."), F.col("tgt_table")), "tgt_column", F.coalesce("transform_expr", "src_column"))
    return [tuple(r) for r in bounded_rows(wanted)]
