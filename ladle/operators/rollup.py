"""Tumbling-window rollups from a declaration, for batches and watermarked streams."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.functions.keys import hash_key


@dataclass(frozen=True)
class Measure:
    name: str
    function: str
    column: str = "1"

    def sql(self) -> str:
        return f"{self.function}({self.column}) AS {self.name}"

    def parts(self) -> dict[str, tuple[str, str]]:
        """What is kept of the measure while its window is open: part -> (function of rows, function that merges parts)."""
        if self.function == "avg":
            return {f"{self.name}_sum": ("sum", "sum"), f"{self.name}_n": ("count", "sum")}
        return {self.name: (self.function, {"count": "sum"}.get(self.function, self.function))}

    def of_parts(self) -> str:
        return f"{self.name}_sum / nullif({self.name}_n, 0) AS {self.name}" if self.function == "avg" else self.name


@dataclass(frozen=True)
class Rollup:
    """What to roll up: the time column and width of its windows, the fields that tell series apart, the measures, and the
    name of the key. The key is the hash of system, fields and window start; it is NULL where a field is."""

    time: str
    width: str
    fields: tuple[str, ...]
    measures: tuple[Measure, ...]
    system: str
    key: str = "hk"
    start: str = "window_start"

    def apply(self, rows: DataFrame, late_after: str | None = None) -> DataFrame:
        """One row per series and window. With ``late_after`` a stream closes a window that long after its end."""
        if late_after is not None:
            rows = rows.withWatermark(self.time, late_after)
        span = F.window(self.time, self.width)
        series = rows.groupBy(span, *self.fields).agg(*map(F.expr, (m.sql() for m in self.measures)))
        opened = series.withColumnRenamed("window", "_span").withColumn(self.start, F.expr("_span.start")).drop("_span")
        return opened.withColumn(self.key, hash_key(f"'{self.system}'", *self.fields, self.start))


    def cells(self, rows: DataFrame) -> DataFrame:
        """Mergeable parts of each series and window, and the last time of its rows. Rows without a time are not counted."""
        parts = [F.expr(f"{f}({m.column}) AS {name}") for m in self.measures for name, (f, _) in m.parts().items()]
        return rows.groupBy(F.window(self.time, self.width).alias("_span"), *self.fields).agg(*parts, F.max(self.time).alias("_last"))

    def merge(self, cells: DataFrame) -> DataFrame:
        parts = [F.expr(f"{f}({name}) AS {name}") for m in self.measures for name, (_, f) in m.parts().items()]
        return cells.groupBy("_span", *self.fields).agg(*parts, F.max("_last").alias("_last"))

    def finish(self, cells: DataFrame) -> DataFrame:
        """The rows that :meth:`apply` gives, from merged parts."""
        opened = cells.select(F.col("_span.start").alias(self.start), *self.fields, *[F.expr(m.of_parts()) for m in self.measures])
        return opened.withColumn(self.key, hash_key(f"'{self.system}'", *self.fields, self.start))


def product(rows: DataFrame, contract: tuple[tuple[str, str, str], ...]) -> DataFrame:
    """The columns a contract promises: (published name, type, source column) each."""
    return rows.select(*[F.col(source).cast(kind).alias(name) for name, kind, source in contract])
