"""Helpers shared by the corpus operators: staged tables, and vectorised work on the bytes of text columns."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ladle import session

#: White space of the word rules: blank, and tab to carriage return.
BLANKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_ROLL = np.uint64(0x9E3779B97F4A7C15 | 1)
_ROLL_INV = np.uint64(pow(int(_ROLL), -1, 1 << 64))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: work is done once and survives lost executors."""
    path = session.shared_dir(df.sparkSession, name)
    with shuffles_deleted(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """What a query shuffles is deleted as soon as its result is written."""
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup, "false")
    spark.conf.set(cleanup, "true")
    try:
        yield
    finally:
        spark.conf.set(cleanup, before)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the rolling multiplier and of its inverse, modulo 2**64."""
    up, down = np.full(n, _ROLL, np.uint64), np.full(n, _ROLL_INV, np.uint64)
    if n:
        up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal byte strings ``data[starts:ends]`` get equal 64-bit hashes; one pass over the bytes for all spans."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], dtype=np.uint64, out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def slices(batch: pa.RecordBatch, column: str, limit: int = 2_000_000, rows: int = 4_000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a batch into row ranges of about ``limit`` text bytes: (first row, end row, bytes, offsets).

    A null text is empty. A text longer than the limit makes a range of its own, so memory follows the longest text.
    """
    texts = pc.fill_null(batch.column(column).cast(pa.large_binary()), b"")
    n = len(texts)
    if not n:
        return
    _, offsets, payload = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(payload, np.uint8) if payload is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(at, at[first] + limit, "right")) - 1
        end = min(max(end, first + 1), n, first + rows)
        yield first, end, data[at[first]:at[end]], at[first:end + 1] - at[first]
        first = end


def lower_ascii(data: np.ndarray) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of word bytes that do not cross documents: starts, ends, document of each."""
    inside = is_word[data]
    starts, ends = inside.copy(), inside.copy()
    if len(data):
        starts[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        edge = offsets[1:-1]
        edge = edge[(edge > 0) & (edge < len(data))]
        starts[edge] = inside[edge]
        ends[edge - 1] = inside[edge - 1]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return s, e, np.searchsorted(offsets, s, "right") - 1


def blank_table() -> np.ndarray:
    table = np.ones(256, bool)
    table[list(BLANKS)] = False
    return table


PIECE_BYTES = 1 << 20


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """(key, the next rows that have it) of sorted batches; a key may come in several runs."""
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.ones(batch.num_rows, bool)
        if batch.num_rows > 1:
            new[1:] = False
            for k in keys:
                a, b = batch.column(k).slice(1), batch.column(k).slice(0, batch.num_rows - 1)
                new[1:] |= ~np.asarray(pc.or_kleene(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b))))
        at = [*np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(at, at[1:]):
            yield tuple(batch.column(k)[a].as_py() for k in keys), batch.slice(a, b - a)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def ordered_digest(df: DataFrame, keys: list[str], order: list[str], value: str, separator: str) -> DataFrame:
    """``keys`` and ``sha256``: lower-case hex of the key's values in ``order``, joined by ``separator``.

    No key is gathered. Rows are range-partitioned by (keys, order) and read in order, as a stream; a key of less than
    ``PIECE_BYTES`` inside one range is hashed there. Larger keys, and the first and last of a range, are passed on in pieces
    of that size, and a second stream hashes the pieces of a key in order. As SHA-256 is sequential, that is one task for a
    key, but it holds one piece at a time.
    """
    fields = df.select(*keys).schema
    passed = T.StructType([*fields, T.StructField("_part", T.IntegerType()), T.StructField("_seq", T.LongType()),
                           T.StructField("_piece", T.BinaryType()), T.StructField("sha256", T.StringType())])
    arrow_passed, arrow_done = to_arrow_schema(passed), to_arrow_schema(T.StructType([*fields, T.StructField("sha256", T.StringType())]))
    joint = separator.encode()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, out, key = TaskContext.get().partitionId(), 0, [], None
        held, size, whole = [], 0, False  # whole: all values of the key so far are held, and it is not the range's first
        for k, rows in _runs(batches, keys):
            if k != key:
                if key is not None and whole:
                    out.append((*key, part, 0, None, hashlib.sha256(joint.join(held)).hexdigest()))
                elif key is not None and held:
                    out.append((*key, part, (seq := seq + 1), joint.join(held), None))
                whole, key, held, size = key is not None, k, [], 0
            for v in rows.column("_value").to_pylist():
                held.append(v.encode())
                size += len(held[-1]) + len(joint)
                if size >= PIECE_BYTES:
                    yield _batch([(*key, part, (seq := seq + 1), joint.join(held), None)], arrow_passed)
                    held, size, whole = [], 0, False
            if len(out) >= 10_000:
                yield _batch(out, arrow_passed)
                out = []
        if held:
            out.append((*key, part, seq + 1, joint.join(held), None))
        yield _batch(out, arrow_passed)

    def streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, out = None, None, []
        for k, rows in _runs(batches, keys):
            if k != key:
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest, first = k, hashlib.sha256(), True
            for piece in rows.column("_piece"):
                digest.update(piece.as_buffer() if first else joint)
                if not first:
                    digest.update(piece.as_buffer())
                first = False
            if len(out) >= 10_000:
                yield _batch(out, arrow_done)
                out = []
        if key is not None:
            out.append((*key, digest.hexdigest()))
        yield _batch(out, arrow_done)

    rows = df.select(*keys, *[F.col(c) for c in order if c not in keys], F.col(value).alias("_value"))
    found = stage(rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).mapInArrow(pieces, passed), "pieces")
    rest = found.filter("_piece IS NOT NULL").repartition(*keys).sortWithinPartitions(*keys, "_part", "_seq")
    done = T.StructType([*fields, T.StructField("sha256", T.StringType())])
    return found.filter("_piece IS NULL").select(*keys, "sha256").unionByName(rest.mapInArrow(streams, done))
