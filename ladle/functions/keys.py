"""Deterministic SHA-256 keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT_SEPARATOR = "\\u001f"


def hash_key(system: str, *parts: str) -> Column:
    """``sha2('SYSTEM|pk1|pk2', 256)`` over the named columns; NULL when any part is NULL.

    ``concat_ws`` skips NULLs, so without the guard a NULL key would hash to a valid looking
    value and (A, NULL, B) would collide with (A, B). SHA-256 of a string is never NULL; saying so
    with ``coalesce`` lets Spark decide ``hk IS NOT NULL`` from the parts alone, instead of hashing
    every row once more inside the filter.
    """
    columns = [system, *[f"cast({p} AS string)" for p in parts]]
    complete = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    return F.expr(f"CASE WHEN {complete} THEN coalesce(sha2(concat_ws('|', {', '.join(columns)}), 256), '') END")


def content_hash(columns: list[str]) -> Column:
    """SHA-256 over ``name=value`` pairs in name order; NULL values leave their pair out.

    Independent of column order, and plain enough for any other engine to reproduce.
    """
    pairs = ", ".join(f"concat('{c}=', cast({c} AS string))" for c in sorted(columns))
    return F.expr(f"sha2(concat_ws('{UNIT_SEPARATOR}', {pairs}), 256)")
