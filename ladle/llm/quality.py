"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata of the text.

Inputs of a score are the words of the whole text hashed to ``BUCKETS``, and statistics of its bytes, words and lines. The
pairwise part is scored in linear time: the sum over pairs of <v_i, v_j> x_i x_j is half of the squared sums minus the
sums of squares, factor by factor. Weights are fitted on at most ``fit_rows`` labelled texts, chosen by a hash of their
id; the model has a fixed size (``(BUCKETS + len(STATS)) * (FACTORS + 1)`` numbers), so it travels with the tasks.

Defined cases: a null or empty text has no words and all statistics zero, and gets the score the model gives to that;
repeated rows get equal scores; labels without a document, or null labels, are left out; several labels of a document
each count; without any label every score is 0.5; extra columns are ignored by :func:`score` and kept by :func:`keep`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.llm import common

BUCKETS, FACTORS = 4096, 8
STATS = ("log_bytes", "log_words", "word_length", "upper", "digit", "symbol", "repeat", "distinct", "line_length", "non_ascii", "loud", "bars")
THRESHOLD = 0.3


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: statistics, and (document, bucket, value) of its hashed words, values of unit length."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    s, e, doc = common.word_spans(data, offsets, common.blank_table())
    h = common.span_hashes(data, s, e)
    words = np.bincount(doc, minlength=n).astype(float)

    def share(flag, of):
        total = np.concatenate([[0], np.cumsum(flag)])
        return (total[offsets[1:]] - total[offsets[:-1]]) / np.maximum(of, 1)

    upper = (data >= 65) & (data <= 90)
    letter = upper | ((data >= 97) & (data <= 122)) | (data >= 128)
    digit = (data >= 48) & (data <= 57)
    blank = ~common.blank_table()[data]
    symbol = ~(letter | digit | blank | np.isin(data, np.frombuffer(b".,;:'\"?()-", np.uint8)))
    again = np.zeros(len(h), bool)
    if len(h) > 1:
        again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    bucket = (h >> np.uint64(20)).astype(np.int64) % BUCKETS
    key, count = np.unique((doc << 40) | (h >> np.uint64(24)).astype(np.int64), return_counts=True)
    distinct = np.bincount(key >> 40, minlength=n)
    pair, times = np.unique(doc * BUCKETS + bucket, return_counts=True)
    at, value = pair // BUCKETS, 1 + np.log(times)
    value = value / np.sqrt(np.bincount(at, value * value, minlength=n))[at]
    lines = share(data == 10, 1) + 1
    stats = np.stack([
        np.log1p(size) / 10, np.log1p(words) / 10, np.bincount(doc, e - s, minlength=n) / np.maximum(words, 1) / 10, share(upper, size), share(digit, size),
        share(symbol, size), np.bincount(doc, again, minlength=n) / np.maximum(words, 1), distinct / np.maximum(words, 1), np.log1p(size / lines) / 10,
        share(data >= 128, size), share(data == 33, words), share(data == 124, words)], axis=1)
    stats[size == 0] = 0
    return stats.astype(np.float32), at, pair % BUCKETS, value.astype(np.float32)


def _score(model: dict, stats: np.ndarray, at: np.ndarray, bucket: np.ndarray, value: np.ndarray) -> np.ndarray:
    n = len(stats)
    x = (stats - model["mean"]) / model["scale"]
    line = model["bias"] + x @ model["w"][BUCKETS:] + np.bincount(at, value * model["w"][bucket], minlength=n)
    v, u = model["v"][:BUCKETS], model["v"][BUCKETS:]
    for f in range(v.shape[1]):
        each = v[bucket, f] * value
        total = np.bincount(at, each, minlength=n) + x @ u[:, f]
        line = line + 0.5 * (total ** 2 - np.bincount(at, each * each, minlength=n) - (x * x) @ (u[:, f] ** 2))
    return 1 / (1 + np.exp(-np.clip(line, -30, 30)))


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, data, offsets in common.slices(batch, "text"):
            stats, at, bucket, value = _features(data, offsets)
            cut = np.searchsorted(at, np.arange(end - first + 1))
            yield pa.RecordBatch.from_arrays([
                batch.column("key").slice(first, end - first), batch.column("label").slice(first, end - first).cast(pa.int64()),
                pa.array([r.tobytes() for r in stats], pa.binary()),
                pa.array([bucket[a:b].astype(np.int32).tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
                pa.array([value[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary())], names=["key", "label", "stats", "bucket", "value"])


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5."""
    return F.crc32(F.coalesce(doc_id, F.lit(-1)).cast("string")) % 5


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = 6000, epochs: int = 30) -> dict:
    """Fit on labelled rows whose fold is not 0, at most ``fit_rows`` of them (a documented bound; features are of whole texts)."""
    known = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").filter(fold(F.col("doc_id")) != 0)
    picked = known.select("doc_id", F.col("quality").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(fit_rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select(F.xxhash64("doc_id", "text", "label").alias("key"), "label", "text")
    found = common.stage(texts.mapInArrow(_sample_features, "key long, label long, stats binary, bucket binary, value binary"), "quality")
    if found.count() > fit_rows:  # several texts of an id: the bound holds for what is collected
        found = found.join(F.broadcast(found.select("key").orderBy("key").limit(fit_rows).distinct()), "key", "left_semi").limit(fit_rows)
    rows = found.drop("key").collect()
    model = {"bias": 0.0, "w": np.zeros(BUCKETS + len(STATS), np.float32), "v": np.zeros((BUCKETS + len(STATS), FACTORS), np.float32),
             "mean": np.zeros(len(STATS), np.float32), "scale": np.ones(len(STATS), np.float32)}
    if not rows:
        return model
    rows.sort(key=lambda r: (bytes(r["stats"]), bytes(r["bucket"]), r["label"]))  # the order of tasks must not matter
    y = np.array([r["label"] for r in rows], np.float32)
    stats = np.stack([np.frombuffer(r["stats"], np.float32) for r in rows])
    model["mean"], model["scale"] = stats.mean(0), np.maximum(stats.std(0), 1e-3)
    x = np.zeros((len(rows), BUCKETS + len(STATS)), np.float32)
    for i, r in enumerate(rows):
        x[i, np.frombuffer(r["bucket"], np.int32)] = np.frombuffer(r["value"], np.float32)
    x[:, BUCKETS:] = np.clip((stats - model["mean"]) / model["scale"], -8, 8)
    rng = np.random.default_rng(7)
    b = np.float32(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    w, v = model["w"], (rng.standard_normal(model["v"].shape) * 0.02).astype(np.float32)
    gw, gv, gb = np.full_like(w, 1e-6), np.full_like(v, 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for part in np.array_split(order, max(1, len(y) // 256)):
            xs = x[part]
            total = xs @ v
            out = b + xs @ w + 0.5 * (total ** 2 - (xs ** 2) @ (v ** 2)).sum(1)
            miss = (1 / (1 + np.exp(-np.clip(out, -30, 30))) - y[part]) / len(part)
            dw = xs.T @ miss + 1e-5 * w
            dv = xs.T @ (miss[:, None] * total) - ((xs ** 2).T @ miss)[:, None] * v + 1e-4 * v
            db = miss.sum()
            gw += dw ** 2
            gv += dv ** 2
            gb += db ** 2
            w = w - 0.1 * dw / np.sqrt(gw)
            v = v - 0.03 * dv / np.sqrt(gv)
            b = b - 0.1 * db / np.sqrt(gb)
    return model | {"bias": float(b), "w": w.astype(np.float32), "v": v.astype(np.float32)}


def score(docs: DataFrame, model: dict, column: str = "score") -> DataFrame:
    """The documents with their score; all columns are kept."""
    schema = docs.select("*", F.lit(0.0).alias(column)).schema

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in common.slices(batch, "text"):
                stats, at, bucket, value = _features(data, offsets)
                clipped = model["mean"] + np.clip((stats - model["mean"]) / model["scale"], -8, 8) * model["scale"]
                own = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(_score(model, clipped, at, bucket, value), pa.float64())],
                                                 names=[*own.schema.names, column])

    return docs.mapInArrow(task, schema)


def keep(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier does not reject."""
    name = common.free_name(docs, "_quality")
    return score(docs, model, name).filter(F.col(name) >= threshold).drop(name)
