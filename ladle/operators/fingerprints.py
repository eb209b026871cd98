"""Insert-only by content: fingerprint trees of a log's batches, and what differs between two states of the log.

A batch's rows fall into leaves by the first bits of a hash of their key. A leaf holds the number of its rows and the sums of both
halves of their content hashes, which do not depend on order or partitioning; a node above holds the sums of its ``FAN`` children.
A tree has at most ``FAN ** DEPTH`` leaves a batch, so it can be kept for every batch that was ever written. Two trees are compared
from the root down, and only children of nodes that differ are looked at. Rows are read again only in leaves that differ.

Content hashes have 64 bits: a change goes unseen if both sums stay equal, with probability about 2**-64 for each changed leaf.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.session import shared_dir
from ladle.sinks import materialize

FAN_BITS, DEPTH = 4, 4


def _leaf(keys: list[str]) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - FAN_BITS * DEPTH)


def tree(rows: DataFrame, batch: str, keys: list[str], columns: list[str]) -> DataFrame:
    """(batch, level, node, rows, low, high) of every node that holds rows; level 0 is the root."""
    content = F.xxhash64(*columns)
    leaves = rows.select(F.col(batch).alias("batch"), _leaf(keys).alias("leaf"), content.alias("h")).groupBy("batch", "leaf").agg(
        F.count("*").alias("rows"), F.sum(F.col("h").bitwiseAND(0xFFFFFFFF)).alias("low"), F.sum(F.shiftrightunsigned("h", 32)).alias("high"))
    above = leaves.select("batch", F.explode(F.sequence(F.lit(0), F.lit(DEPTH))).alias("level"), "leaf", "rows", "low", "high")
    node = F.expr(f"shiftright(leaf, {FAN_BITS} * ({DEPTH} - level))")
    return above.groupBy("batch", "level", node.alias("node")).agg(
        F.sum("rows").alias("rows"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low"), F.sum(F.col("high").cast("decimal(38,0)")).alias("high"))


def differing(before: DataFrame, after: DataFrame) -> DataFrame:
    """(batch, node): leaves of the batches of ``before`` that do not hold the same rows in both trees.

    Batches that only ``after`` has are new, which is what an insert-only log is for.
    """
    sums = F.struct("rows", "low", "high")
    both = before.select("batch", "level", "node", sums.alias("was"), F.lit(None).cast("struct<rows:bigint,low:decimal(38,0),high:decimal(38,0)>").alias("now")).unionByName(
        after.join(before.select("batch").distinct(), "batch", "left_semi").select("batch", "level", "node", F.lit(None).cast("struct<rows:bigint,low:decimal(38,0),high:decimal(38,0)>").alias("was"), sums.alias("now")))
    suspects = None
    for level in range(DEPTH + 1):
        nodes = both.filter(F.col("level") == level)
        if suspects is not None:
            parents = suspects.withColumnRenamed("node", "parent")
            nodes = nodes.withColumn("parent", F.shiftright("node", FAN_BITS)).join(parents, ["batch", "parent"], "left_semi")
        met = nodes.groupBy("batch", "node").agg(F.max("was").alias("was"), F.max("now").alias("now"))
        suspects = met.filter(~F.col("was").eqNullSafe(F.col("now"))).select("batch", "node")
    return suspects


def violations(before: DataFrame, after: DataFrame, batch: str, keys: list[str], columns: list[str], leaves: DataFrame | None = None) -> DataFrame:
    """batch, keys, lost, changed, added: what was done to rows of batches that ``before`` has, for every key that is not as it was.

    ``columns`` are what must not change. Only rows in differing leaves are compared; copies of a row count.
    """
    if leaves is None:
        # Trees are small and read once for each level, so they are written.
        trees = [materialize(tree(df, batch, keys, columns), shared_dir(df.sparkSession, "fingerprints")) for df in (before, after)]
        leaves = materialize(differing(*trees), shared_dir(before.sparkSession, "differing"))

    def rows(df: DataFrame, side: int) -> DataFrame:
        # Leaves are numbers below FAN ** DEPTH for each batch that differs; Spark broadcasts them while they measure small.
        return df.select(F.col(batch).alias("batch"), *keys, F.xxhash64(*columns).alias("h"), _leaf(keys).alias("node"), F.lit(side).alias("side")).join(leaves, ["batch", "node"], "left_semi")

    each = rows(before, 0).unionByName(rows(after, 1)).groupBy("batch", *keys, "h").agg(F.count_if(F.col("side") == 0).alias("was"), F.count_if(F.col("side") == 1).alias("now"))
    per_key = each.groupBy("batch", *keys).agg(F.sum(F.greatest(F.col("was") - F.col("now"), F.lit(0))).alias("missing"), F.sum(F.greatest(F.col("now") - F.col("was"), F.lit(0))).alias("extra"))
    changed = F.least("missing", "extra")
    return per_key.filter("missing > 0 OR extra > 0").select("batch", *keys, (F.col("missing") - changed).alias("lost"), changed.alias("changed"), (F.col("extra") - changed).alias("added"))


def audit(before: DataFrame, after: DataFrame, batch: str, keys: list[str], columns: list[str]) -> DataFrame:
    """One row per batch of ``before``: its rows, how many were lost, changed and added since, and whether it is as it was."""
    sizes = before.groupBy(F.col(batch).alias("batch")).agg(F.count("*").alias("rows"))
    found = violations(before, after, batch, keys, columns).groupBy("batch").agg(*[F.sum(c).alias(c) for c in ("lost", "changed", "added")])
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("lost", "changed", "added")]
    return sizes.join(found, "batch", "left").select("batch", "rows", *counts).withColumn("insert_only", F.expr("lost + changed + added = 0"))
