"""Text embedding by feature hashing, and exact top-k by cosine similarity."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIMENSIONS = 256
QUESTIONS_AT_ONCE = 4096
MAX_LABELS = 4096
NOT_TOKEN = r"[^\p{L}\p{N}]+"
TEXTS_AT_ONCE = 1024
BYTES_AT_ONCE = 1 << 20
VECTORS_AT_ONCE = 1024


def token_matrix(texts: pa.Array) -> np.ndarray:
    """Term counts in 256 hash buckets, one row per text; a token's bucket is the second byte of its MD5.

    Tokens are runs of letters and digits of any script. Splitting, counting and de-duplication are
    columnar; only distinct tokens are hashed.
    """
    lists = pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts, "")), NOT_TOKEN)
    owner = np.asarray(pc.list_parent_indices(lists))
    words = pc.list_flatten(lists).dictionary_encode()
    buckets = np.array([hashlib.md5(w.encode()).digest()[1] if w else -1 for w in words.dictionary.to_pylist()],
                       dtype=np.int64)
    bucket = buckets[np.asarray(words.indices)] if len(buckets) else np.zeros(0, dtype=np.int64)
    real = bucket >= 0
    cells = np.bincount(owner[real] * DIMENSIONS + bucket[real], minlength=len(texts) * DIMENSIONS)
    return cells.reshape(len(texts), DIMENSIONS).astype(np.float32)


def token_vector(text: str) -> np.ndarray:
    return token_matrix(pa.array([text], pa.string()))[0]


def _pieces(texts: pa.Array) -> Iterator[pa.Array]:
    """Runs of at most TEXTS_AT_ONCE texts and about BYTES_AT_ONCE bytes, at least one text each."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64))
    start = 0
    while start < len(texts):
        base = ends[start - 1] if start else 0
        end = min(max(int(np.searchsorted(ends, base + BYTES_AT_ONCE, "right")), start + 1), start + TEXTS_AT_ONCE)
        yield texts.slice(start, end - start)
        start = min(end, len(texts))


@F.arrow_udf(T.ArrayType(T.FloatType()))
def embed(texts: pa.Array) -> pa.Array:
    cells = np.empty(len(texts) * DIMENSIONS, dtype=np.float32)
    at = 0
    for piece in _pieces(texts):
        cells[at:at + len(piece) * DIMENSIONS] = token_matrix(piece).reshape(-1)
        at += len(piece) * DIMENSIONS
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(cells) + 1, DIMENSIONS, dtype=np.int32)), pa.array(cells))


def embed_column(text: Column | str) -> Column:
    return embed(F.col(text) if isinstance(text, str) else text)


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """List column to a dense matrix; a vector that is NULL or of another width becomes zeros."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.asarray(arr.value_lengths().fill_null(0))
    flat = np.asarray(arr.flatten().fill_null(0.0), dtype=np.float64)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else []
    for i, (s, n) in enumerate(zip(starts, lengths)):
        if n == width:
            out[i] = flat[s:s + n]
    return out


def _unit(m: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def _best_rows(scores: np.ndarray, order_key: np.ndarray, k: int) -> list[np.ndarray]:
    """Row numbers of the k best scores per column; only rows at or above the k-th score are sorted."""
    n = len(scores)
    floor = np.partition(scores, n - k, axis=0)[n - k] if n > k else np.full(scores.shape[1], -np.inf)
    best = []
    for j in range(scores.shape[1]):
        rows = np.flatnonzero(scores[:, j] >= floor[j])
        best.append(rows[np.lexsort((order_key[rows], -scores[rows, j]))[:k]])
    return best


def top_k(index: DataFrame, key: str, vector: str, questions: dict[str, list[float]], k: int) -> DataFrame:
    """``(question, key, score)``: the k nearest vectors of every question, exactly.

    The question list is the caller's; it travels with the task, which works through it in blocks, so the index is read
    once. Slices of an Arrow batch are scored by one matrix product per block and cut to k rows per question before anything
    is shuffled, so neither pairs nor the index ever move. Ties go to the smaller key. A NULL vector
    scores 0; a vector of another width than the questions cannot be compared and takes no part.
    """
    names = list(questions)
    width = len(questions[names[0]])
    unit_q = _unit(np.array([questions[n] for n in names], dtype=np.float64))
    key_type = dict(index.dtypes)[key]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, VECTORS_AT_ONCE) for b in batches for at in range(0, b.num_rows, VECTORS_AT_ONCE)):
            # Widths are checked here: a filter above the scan would evaluate the vector's expression a second time.
            fits = np.asarray(pc.fill_null(pc.equal(pc.list_value_length(batch.column(1)), width), True))
            if not fits.any():
                continue
            keys, column = (batch.column(i).filter(pa.array(fits)) for i in (0, 1))
            unit, order_key = _unit(_matrix(column, width)), np.asarray(keys.to_pandas())
            for first in range(0, len(names), QUESTIONS_AT_ONCE):
                block = names[first:first + QUESTIONS_AT_ONCE]
                scores = np.round(unit @ unit_q[first:first + QUESTIONS_AT_ONCE].T, 6)
                picks = _best_rows(scores, order_key, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n for n, p in zip(block, picks) for _ in p], pa.string()), keys.take(pa.array(np.concatenate(picks))),
                     pa.array(np.concatenate([scores[p, j] for j, p in enumerate(picks)]), pa.float64())],
                    ["question", key, "score"])

    partial = index.select(key, vector).mapInArrow(search, f"question string, {key} {key_type}, score double")
    rank = F.row_number().over(Window.partitionBy("question").orderBy(F.col("score").desc(), F.col(key)))
    return partial.withColumn("rank", rank).filter(F.col("rank") <= k)


def centroids(df: DataFrame, label: str, vector: str) -> dict[str, list[float]]:
    """Mean vector per label. Batches fold to one sum per label, so only sums are shuffled; the
    number of labels is checked. Vectors must be of one width; others raise."""
    widths = df.filter(F.col(vector).isNotNull()).select(F.size(vector)).distinct().limit(2).collect()
    if len(widths) > 1:
        raise ValueError("vectors of several widths have no mean")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            names, codes = np.unique(np.asarray(batch.column(0).cast(pa.string()).fill_null("")), return_inverse=True)
            lengths = np.asarray(batch.column(1).value_lengths().fill_null(0))
            dense = _matrix(batch.column(1), int(lengths.max()))
            sums = np.zeros((len(names), dense.shape[1]))
            np.add.at(sums, codes, dense)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(list(sums), pa.list_(pa.float64())), pa.array(np.bincount(codes))],
                ["label", "total", "n"])

    partial = df.select(F.col(label).cast("string"), vector).mapInArrow(fold, "label string, total array<double>, n bigint")
    means = (partial.select("label", "n", F.posexplode("total").alias("pos", "x"))
             .groupBy("label", "pos").agg((F.sum("x") / F.sum("n")).alias("m"))
             .groupBy("label").agg(F.array_sort(F.collect_list(F.struct("pos", "m"))).alias("v")))
    rows = means.select("label", "v.m").limit(MAX_LABELS + 1).collect()
    if len(rows) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels")
    return {r[0]: list(r[1]) for r in rows}


def search_text(index: DataFrame, key: str, vector: str, question: str, k: int = 5) -> DataFrame:
    return top_k(index, key, vector, {question: token_vector(question).tolist()}, k)


def register_search_function(spark: SparkSession, index: DataFrame, key: str, text: str, vector: str, k: int = 5) -> None:
    """SQL table function ``search_customer_profiles(question)`` over an index frame."""
    index.select(F.col(key).alias("customer_hk"), F.col(text).alias("profile_text"),
                 F.col(vector).alias("embedding")).createOrReplaceTempView("ladle_profile_index")
    spark.udf.register("embed_text", embed)
    dot = "aggregate(zip_with({a}, {b}, (x, y) -> cast(x AS double) * y), 0D, (s, v) -> s + v)"
    both, left, right = (dot.format(a=a, b=b) for a, b in [("embedding", "q"), ("embedding", "embedding"), ("q", "q")])
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION search_customer_profiles(question STRING)
        RETURNS TABLE (customer_hk STRING, profile_text STRING, score DOUBLE)
        RETURN SELECT customer_hk, profile_text, score FROM (
            SELECT customer_hk, profile_text, round(coalesce({both} / nullif(sqrt({left}) * sqrt({right}), 0D), 0D), 6) AS score
            FROM ladle_profile_index CROSS JOIN (SELECT embed_text(question) AS q))
        ORDER BY score DESC, customer_hk LIMIT {k}""")


def sync_index(index: DataFrame, changes: DataFrame, key: str, text: str, vector: str) -> DataFrame:
    """Index after a change feed: changed keys are embedded again, deleted keys leave, the rest stays."""
    touched = changes.select(key)
    fresh = changes.filter("change_type <> 'delete'").select(key, text, embed_column(text).alias(vector))
    return index.join(touched, key, "left_anti").select(key, text, vector).unionByName(fresh)
