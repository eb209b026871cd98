"""Clustered layout along a space-filling curve, so that a filter on any one of several columns skips most of the files.

A sort by (a, b) helps filters on ``b`` little: every file holds one narrow range of ``a`` and all of ``b``. Here each column is
replaced by its rank among quantiles, and the bits of the ranks are interleaved (Z-order). Rows are range-partitioned and
sorted by that number, so a file is a small box in all columns. Ranks instead of values make boxes hold equal numbers of rows.

Splitters are quantiles of at most ``sample_rows`` sampled rows, ``2 ** bits - 1`` for each column. They decide where a row
lies and never whether it is kept. Rows of one box are told apart by a hash of all their columns, so a box that holds a third of the
table (a NULL key on one day) still spreads over several files; only fully equal rows stay together. NULL ranks first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 8
SAMPLE_ROWS = 20_000


def splitters(df: DataFrame, keys: list[str], bits: int = BITS, sample_rows: int = SAMPLE_ROWS) -> dict[str, list]:
    """Up to ``2 ** bits - 1`` quantiles of every key, from a bounded sample."""
    rows = df.count()
    picked = df.select(*keys) if rows <= sample_rows else df.select(*keys).sample(0.9 * sample_rows / rows, seed=7)
    taken = picked.limit(sample_rows).collect()
    out = {}
    for key in keys:
        values = sorted(r[key] for r in taken if r[key] is not None)
        steps = 2 ** bits
        out[key] = [values[len(values) * i // steps] for i in range(1, steps)] if values else []
    return out


def rank(column: Column, values: list, bits: int) -> Column:
    """How many of the sorted ``values`` are not above the column's value: a binary search of ``bits`` steps. NULL is 0."""
    if not values:
        return F.lit(0)
    known = F.array(*[F.lit(v) for v in values])
    steps = F.array(*[F.lit(2 ** b) for b in reversed(range(bits))])
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(known, at + step - 1) <= column, at + step).otherwise(at))
    return F.coalesce(found, F.lit(0))


def interleaved(ranks: list[Column], bits: int) -> Column:
    """One number from the bits of all ranks, the highest bits first."""
    out = F.lit(0).cast("long")
    for bit in range(bits):
        for i, r in enumerate(ranks):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(r, bit).bitwiseAND(1).cast("long"), bit * len(ranks) + i))
    return out


def write_curve(df: DataFrame, path: str, keys: list[str], files: int | None = None, bits: int = BITS) -> DataFrame:
    """Write ``df`` along the curve over ``keys`` and return it as read back. ``files``: the session's shuffle partitions unless given."""
    if bits * len(keys) > 62:
        raise ValueError("at most 62 bits for all keys together")
    bounds = splitters(df, keys, bits)
    hashed = [f.name for f in df.schema if not f.dataType.simpleString().startswith(("map", "variant"))]
    ranks = F.struct(*[rank(F.col(k), bounds[k], bits).alias(k) for k in keys])
    # All columns ride in one struct, so no column of the table can clash with the curve's.
    placed = df.select(F.struct(*df.columns).alias("row"), ranks.alias("ranks"), F.xxhash64(*hashed).alias("tie")).select(
        "row", interleaved([F.col("ranks").getField(k) for k in keys], bits).alias("place"), "tie")
    dealt = placed.repartitionByRange(files, "place", "tie") if files else placed.repartitionByRange("place", "tie")
    dealt.sortWithinPartitions("place", "tie").select("row.*").write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
