"""A small metric layer: named dimensions, mergeable states and measures of them, over a lattice of cuts."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _compact(kind: T.DataType, key: Column) -> Column:
    """Bytes that differ where strings differ, half as many where they are lowercase hex digits (hash keys); other types as they are."""
    if kind != T.StringType():
        return key
    return F.when(F.lower(F.hex(F.unhex(key))) == key, F.concat(F.lit(b"\x01"), F.unhex(key))).otherwise(F.concat(F.lit(b"\x00"), key.cast("binary")))


@dataclass(frozen=True)
class MetricView:
    """``sums`` and ``distincts`` are the states: a column to add up, or one whose different values count. Measures are
    expressions over states, so a ratio is a ratio of totals at the grain of its cut."""

    dimensions: dict[str, str]
    sums: dict[str, str]
    distincts: dict[str, str]
    measures: dict[str, str]
    base_filter: str | None = None
    synonyms: dict[str, list[str]] = field(default_factory=dict)

    def resolve(self, name: str) -> str:
        """Name of a dimension or measure, also by synonym."""
        if name in self.dimensions or name in self.measures:
            return name
        for target, words in self.synonyms.items():
            if name.lower() in words:
                return target
        raise KeyError(name)

    def _states(self, measures: list[str]) -> tuple[list[str], list[str]]:
        """The sums and distinct counts that measures are made of."""
        used = {word for m in measures for word in re.findall(r"[A-Za-z_]\w*", self.measures[self.resolve(m)])}
        return [s for s in self.sums if s in used], [d for d in self.distincts if d in used]

    def _held_by(self, key: str, dims: list[str]) -> str:
        """The column of cells that has the values of a counted key: a dimension of the same expression, else its own."""
        return next((d for d in dims if self.dimensions.get(d) == self.distincts[key]), key)

    def cells(self, source: DataFrame, measures: list[str], cuts: list[list[str]]) -> DataFrame:
        """The finest cells that all ``cuts`` can be taken from: one row per value of their dimensions and of the counted keys.

        This is the one pass over the source. Values of a key stay apart, so that every distinct count is exact; a key that is
        also a dimension is held, shuffled and stored once, and one that is only counted is kept in fewer bytes.
        """
        sums, keys = self._states(measures)
        dims = list(dict.fromkeys(self.resolve(d) for by in cuts for d in by))
        rows = source.filter(self.base_filter) if self.base_filter else source
        own = [k for k in keys if self._held_by(k, dims) == k]
        group = [F.expr(self.dimensions[d]).alias(d) for d in dims] + [F.expr(self.distincts[k]).alias(k) for k in own]
        folded = [F.sum(F.expr(self.sums[s])).alias(s) for s in sums]
        cells = rows.groupBy(*group).agg(*folded) if folded else rows.select(*group).distinct()
        # Only now: a source that lies by the key itself is folded where it lies.
        return cells.withColumns({k: _compact(cells.schema[k].dataType, F.col(k)) for k in own})

    def cut(self, cells: DataFrame, measures: list[str], by: list[str] | None = None) -> DataFrame:
        """Measures by some of the dimensions of ``cells``.

        Cells fold to (cut, key) for each counted key, and each folded row then counts one; sums ride along with the first key. No
        row is multiplied by the number of keys, and a key or cell that holds most rows is combined before each shuffle.
        """
        sums, keys = self._states(measures)
        dims = [self.resolve(d) for d in by or []]
        kinds = {f.name: f.dataType for f in cells.schema}

        def total(s: str) -> Column:
            return F.sum(s).cast(kinds[s]).alias(s)

        def folded(key: str, first: bool) -> DataFrame:
            taken = cells.groupBy(*dims, F.col(self._held_by(key, cells.columns)).alias(key))
            one = taken.agg(*map(total, sums)) if first and sums else taken.agg(F.lit(True).alias("_")).drop("_")
            return one.withColumn(key, F.col(key).isNotNull().cast("long"))

        if keys:
            parts = [folded(k, i == 0) for i, k in enumerate(keys)]
            rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        else:
            rows = cells
        counts = [F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in keys]
        totals = rows.groupBy(*dims).agg(*map(total, sums), *counts)
        return totals.select(*dims, *[F.expr(self.measures[m]).alias(m) for m in map(self.resolve, measures)])

    def query(self, source: DataFrame, measures: list[str], by: list[str] | None = None, keep: Callable[[DataFrame], DataFrame] = lambda cells: cells) -> DataFrame:
        """Measures by any subset of dimensions. ``keep`` may store the cells, which are read once per counted key."""
        cells = self.cells(source, measures, [by or []])
        return self.cut(keep(cells) if len(self._states(measures)[1]) > 1 else cells, measures, by)

    def lattice(self, source: DataFrame, measures: list[str], cuts: list[list[str]], keep: Callable[[DataFrame], DataFrame] = lambda cells: cells) -> DataFrame:
        """All ``cuts`` from one pass over the source: the name of the cut, every dimension (NULL where a cut lacks it), the measures."""
        cells = keep(self.cells(source, measures, cuts))
        dims = [c for c in self.dimensions if c in cells.columns]
        kinds = dict(cells.dtypes)

        def one(by: list[str]) -> DataFrame:
            named = [self.resolve(d) for d in by]
            return self.cut(cells, measures, by).select(
                F.lit(",".join(named)).alias("cut"), *[F.col(d) if d in named else F.lit(None).cast(kinds[d]).alias(d) for d in dims], *map(self.resolve, measures))

        return reduce(DataFrame.unionByName, map(one, cuts))


# The sales metrics (names, expressions, base filter, synonyms).
SALES_METRICS = MetricView(
    dimensions={"order_date": "order_date", "source_system": "source_system", "customer": "customer_hk"},
    sums={"amount": "order_amount_usd"},
    distincts={"orders": "order_hk", "customers": "customer_hk"},
    measures={
        "revenue_usd": "amount",
        "order_count": "orders",
        "avg_order_value": "amount / nullif(orders, 0)",
        "active_customers": "customers",
    },
    base_filter="order_amount_usd IS NOT NULL",
    synonyms={
        "source_system": ["erp", "system", "region system"],
        "revenue_usd": ["sales", "total sales", "net revenue"],
        "order_count": ["number of orders", "order volume"],
        "avg_order_value": ["aov", "average deal size"],
    },
)
