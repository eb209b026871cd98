"""Toxicity classifier: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Inputs of a score are which words, pairs of neighbours and pairs with one or two words between them occur in the whole text, each
hashed to one of ``BUCKETS`` coordinates; how often does not count, and neither does the length. Every coordinate has a rate of its
own, ``alpha / (beta + sqrt(sum of its squared gradients))``, and an L1 penalty that keeps it at exactly zero until its gradients
agree; what is left is a short list of weights that travels with the scoring tasks.

Learning is sequential by nature. It passes ``epochs`` times over at most ``fit_rows`` labelled texts, chosen by a hash of their id (the
documented bound), in one streaming task; between passes the state, ``2 * (BUCKETS + 1)`` numbers, is all that is held. Scoring has no bound.

Defined cases: a null or empty text has no coordinate and gets the score of the bias; repeated rows get equal scores; labels without a
document, and null or other labels, are left out; several labels of a document each count; several texts of an id each count, and the
bound holds after the join; without any label every score is 0.5; a null doc_id counts as -1 in the fold and is never learned from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.llm import common

BUCKETS, GAPS = 1 << 18, (1, 2, 3)
THRESHOLD = 0.5
#: alpha, beta, L2, and L1 for each root of a labelled text: chance gradients of a common word sum to about so much.
ALPHA, BETA, L2, L1_ROOT = 1.0, 1.0, 0.1, 0.23


def _is_word() -> np.ndarray:
    """Letters, digits and all bytes of characters beyond ASCII."""
    table = np.zeros(256, bool)
    table[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
    return table


def _coordinates(data: np.ndarray, offsets: np.ndarray, of_use: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(document, coordinate) of what occurs in each text, sorted, each once; only those ``of_use``, if that is given."""
    data = common.lower_ascii(data)
    s, e, doc = common.word_spans(data, offsets, _is_word())
    h = common.span_hashes(data, s, e)
    grams, at = [h], [doc]
    for gap in GAPS:
        same = doc[gap:] == doc[:-gap] if len(doc) > gap else np.zeros(0, bool)
        a, b = h[:-gap][same] if len(same) else h[:0], h[gap:][same] if len(same) else h[:0]
        grams.append(common.mix(a * np.uint64(0x9E3779B97F4A7C15) + b + np.uint64(gap)))
        at.append(doc[gap:][same] if len(same) else doc[:0])
    at, coordinate = np.concatenate(at).astype(np.int64), (np.concatenate(grams) >> np.uint64(40)).astype(np.int64) & (BUCKETS - 1)
    if of_use is not None:
        used = of_use[coordinate]
        at, coordinate = at[used], coordinate[used]
    key = at * BUCKETS + coordinate
    key.sort()
    key = key[np.diff(key, prepend=-1) != 0]
    return key // BUCKETS, key % BUCKETS


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5."""
    return F.crc32(F.coalesce(doc_id, F.lit(-1)).cast("string")) % 5


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, end, data, offsets in common.slices(batch, "text"):
            at, coordinate = _coordinates(data, offsets)
            cut = np.searchsorted(at, np.arange(end - first + 1))
            own = batch.slice(first, end - first)
            yield pa.RecordBatch.from_arrays([
                own.column("turn_order"), own.column("label").cast(pa.int64()),
                pa.array([coordinate[a:b].astype(np.int32).tobytes() for a, b in zip(cut, cut[1:])], pa.binary())], names=["turn_order", "label", "coordinates"])


def _weights(z: np.ndarray, n: np.ndarray, i: np.ndarray | slice, l1: float) -> np.ndarray:
    return np.where(np.abs(z[i]) <= l1, 0.0, -(z[i] - np.sign(z[i]) * l1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))


def _bias(z: np.ndarray, n: np.ndarray) -> float:
    return float(-z[-1] / ((BETA + np.sqrt(n[-1])) / ALPHA))


def learn(z: np.ndarray, n: np.ndarray, label: int, coordinates: np.ndarray, l1: float) -> None:
    """One step: predict, then move what the text touches. The last coordinate is the bias, which has no penalty."""
    w, bias = _weights(z, n, coordinates, l1), _bias(z, n)
    g = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -30, 30))) - label
    z[coordinates] += g - (np.sqrt(n[coordinates] + g * g) - np.sqrt(n[coordinates])) / ALPHA * w
    n[coordinates] += g * g
    z[-1] += g - (np.sqrt(n[-1] + g * g) - np.sqrt(n[-1])) / ALPHA * bias
    n[-1] += g * g


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = 20_000, epochs: int = 6) -> dict:
    """Weights learned from labelled rows whose fold is not 0: ``index`` and ``weight`` of the coordinates in use, and ``bias``."""
    known = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").filter(fold(F.col("doc_id")) != 0)
    order = F.xxhash64(F.col("doc_id"), F.lit("toxic"))
    picked = known.select("doc_id", F.col("toxic").alias("label")).orderBy(order, "doc_id", "label").limit(fit_rows)
    # ``picked`` has at most fit_rows pairs of numbers, so it is broadcast and no text is shuffled.
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").withColumn("turn_order", F.xxhash64("doc_id", "text", "label"))
    rows = common.stage(texts.select("turn_order", "label", "text").mapInArrow(_rows, "turn_order bigint, label bigint, coordinates binary"), "toxic")
    if rows.count() > fit_rows:  # several texts of an id: the bound holds for what was joined
        rows = common.stage(rows.join(F.broadcast(rows.select("turn_order").orderBy("turn_order").limit(fit_rows).distinct()), "turn_order", "left_semi").limit(fit_rows), "toxic")
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    spark, l1 = docs.sparkSession, L1_ROOT * rows.count() ** 0.5
    for _ in range(epochs):
        state = spark.sparkContext.broadcast((z, n))

        def task(batches: Iterator[pa.RecordBatch], state=state) -> Iterator[pa.RecordBatch]:
            z, n = (x.copy() for x in state.value)
            for batch in batches:
                for label, coordinates in zip(batch.column("label").to_pylist(), batch.column("coordinates")):
                    learn(z, n, label, np.frombuffer(coordinates.as_buffer(), np.int32), l1)
            yield pa.RecordBatch.from_arrays([pa.array([z.tobytes()], pa.binary()), pa.array([n.tobytes()], pa.binary())], names=["z", "n"])

        found = rows.coalesce(1).sortWithinPartitions("turn_order", "label", "coordinates").mapInArrow(task, "z binary, n binary").first()
        state.unpersist()
        if found is None:
            break
        z, n = np.frombuffer(found["z"]), np.frombuffer(found["n"])
    w = _weights(z, n, slice(0, BUCKETS), l1)
    index = np.flatnonzero(w)
    return {"index": index.astype(np.int32), "weight": w[index].astype(np.float32), "bias": _bias(z, n)}


def score(docs: DataFrame, model: dict, column: str = "score") -> DataFrame:
    """The documents with their score; all columns are kept, but for one named like ``column``, which is replaced."""
    kept = docs.drop(column)
    schema = kept.select("*", F.lit(0.0).alias(column)).schema
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros(BUCKETS, np.float32)
        dense[shared.value["index"]] = shared.value["weight"]
        for batch in batches:
            for first, end, data, offsets in common.slices(batch, "text"):
                at, coordinate = _coordinates(data, offsets, dense != 0)
                line = shared.value["bias"] + np.bincount(at, dense[coordinate], minlength=end - first)
                own = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(1 / (1 + np.exp(-np.clip(line, -30, 30))), pa.float64())], names=[*own.schema.names, column])

    return kept.mapInArrow(task, schema)
