"""Stored vector index: an inverted file of coarse cells with product-quantised residuals.

``build`` trains in Spark on a bounded sample (``sample_rows``, the documented bound): Lloyd rounds for the coarse centroids, then
for one codebook per slice of the residuals, all slices in one pass. Each round sends the centroids out and gets one sum per
task and centroid back, folded before they are collected, so the driver holds the size of the model whatever the size of the table.
Every vector, not only the sample, is then written below ``cells``, partitioned by its nearest cell, with its code.

``search`` ranks cells by the question on the driver and reads only the nearest ones (partition filters in the plan): first key and
code, cut to a short list by table look-ups, then the vectors of the short list for an exact score. ``sync`` applies a change feed and
rewrites only the cells that changed keys leave or enter. Each write of the index has a version; the model stays with it.

A NULL vector or one of another width than the model is kept in cell -1, which no search reads, and has no code. Ties go to the smaller key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladle.operators.vectors import _best_rows, _matrix, _unit
from ladle.session import shared_dir

ROUNDS = 8
NO_CELL = -1


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmin((c * c).sum(1) - 2 * (x @ c.T), axis=1)


def _slices(width: int, parts: int) -> list[slice]:
    edge = np.linspace(0, width, parts + 1).astype(int)
    return [slice(a, b) for a, b in zip(edge, edge[1:])]


def _lloyd(sample: DataFrame, coarse: np.ndarray | None, books: list[np.ndarray], rounds: int, seed: int) -> list[np.ndarray]:
    """Means of each codebook's slice of the (residual, if ``coarse`` is given) sample vectors after some rounds."""
    width = sum(b.shape[1] for b in books)
    parts = _slices(width, len(books))
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        now = [b.copy() for b in books]

        def task(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            sums, counts = [np.zeros_like(b) for b in now], [np.zeros(len(b)) for b in now]
            for batch in batches:
                x = _unit(_matrix(batch.column(0), width))
                if coarse is not None:
                    x = x - coarse[_nearest(x, coarse)]
                for part, book, total, count in zip(parts, now, sums, counts):
                    at = _nearest(x[:, part], book)
                    np.add.at(total, at, x[:, part])
                    count += np.bincount(at, minlength=len(book))
            rows = [(i, j, count[j], total[j].tolist()) for i, (total, count) in enumerate(zip(sums, counts)) for j in np.flatnonzero(count).tolist()]
            book, entry, n, total = zip(*rows) if rows else ([], [], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(book, pa.int32()), pa.array(entry, pa.int32()), pa.array(n, pa.float64()), pa.array(list(total), pa.list_(pa.float64()))],
                                             names=["book", "entry", "n", "total"])

        folded = sample.mapInArrow(task, "book int, entry int, n double, total array<double>").select("book", "entry", "n", F.posexplode("total").alias("pos", "x"))
        means = folded.groupBy("book", "entry", "pos").agg((F.sum("x") / F.sum("n")).alias("m")).groupBy("book", "entry").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda p: p["m"]).alias("m")).collect()
        found = {(r["book"], r["entry"]): np.array(r["m"]) for r in means}
        for i, book in enumerate(books):
            used = [j for j in range(len(book)) if (i, j) in found]
            for j in range(len(book)):
                # A centroid that nothing is near to starts again beside one that is in use.
                book[j] = found[i, j] if (i, j) in found else found[i, used[int(rng.integers(len(used)))]] * (1 + 1e-3 * rng.standard_normal(book.shape[1])) if used else book[j]
    return books


def _placed(rows: DataFrame, key: str, vector: str, model: dict) -> DataFrame:
    """key, vector, code, cell of every row."""
    coarse, books, width = model["coarse"], model["books"], model["coarse"].shape[1]
    parts = _slices(width, len(books))
    schema = T.StructType([rows.schema[key], rows.schema[vector], T.StructField("code", T.BinaryType()), T.StructField("cell", T.IntegerType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.asarray(batch.column(1).value_lengths().fill_null(-1))
            x = _unit(_matrix(batch.column(1), width))
            cell = _nearest(x, coarse)
            rest = x - coarse[cell]
            codes = np.stack([_nearest(rest[:, p], b) for p, b in zip(parts, books)], axis=1).astype(np.uint8)
            fits = lengths == width
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([c.tobytes() if ok else None for c, ok in zip(codes, fits)], pa.binary()),
                pa.array(np.where(fits, cell, NO_CELL).astype(np.int32))], names=schema.names)

    return rows.select(key, vector).mapInArrow(task, schema)


def build(rows: DataFrame, key: str, vector: str, path: str, cells: int = 64, parts: int = 8, entries: int = 64, sample_rows: int = 20_000) -> None:
    """Train on at most ``sample_rows`` vectors, chosen by a hash of the key, and write all rows below ``path``."""
    spark = rows.sparkSession
    usable = rows.filter(F.col(vector).isNotNull()).select(vector, F.xxhash64(key).alias("_h"), F.size(vector).alias("_w"))
    width = usable.groupBy("_w").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "_w").first()
    if width is None:
        raise ValueError("no vector to train on")
    chosen = shared_dir(spark, "vector_sample")
    usable.filter(F.col("_w") == width["_w"]).orderBy("_h").limit(sample_rows).select(vector).write.parquet(chosen)
    sample = spark.read.parquet(chosen)
    first = _unit(np.array([r[0] for r in sample.limit(max(cells, entries)).collect()], dtype=np.float64))
    rng = np.random.default_rng(11)

    def start(m: np.ndarray, n: int) -> np.ndarray:
        return m[np.arange(n) % len(m)] + 1e-4 * rng.standard_normal((n, m.shape[1]))

    coarse = _lloyd(sample, None, [start(first, cells)], ROUNDS, 1)[0]
    rest = first - coarse[_nearest(first, coarse)]
    books = _lloyd(sample, coarse, [start(rest[:, p], entries) for p in _slices(width["_w"], parts)], ROUNDS, 2)
    model = [("coarse", 0, j, c.tolist()) for j, c in enumerate(coarse)] + [("book", i, j, c.tolist()) for i, b in enumerate(books) for j, c in enumerate(b)]
    spark.createDataFrame(model, "kind string, book int, entry int, centre array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/model")
    _placed(rows, key, vector, load_model(spark, path)).repartition("cell", F.xxhash64(key) % 8).write.mode("overwrite").partitionBy("cell").parquet(f"{path}/cells")


def load_model(spark: SparkSession, path: str) -> dict:
    """The trained centroids; their number and width are parameters of the index, so they fit the driver and every task."""
    rows = sorted(spark.read.parquet(f"{path}/model").collect(), key=lambda r: (r["kind"], r["book"], r["entry"]))
    books = sorted({r["book"] for r in rows if r["kind"] == "book"})
    return {"coarse": np.array([r["centre"] for r in rows if r["kind"] == "coarse"]),
            "books": [np.array([r["centre"] for r in rows if r["kind"] == "book" and r["book"] == b]) for b in books]}


def search(spark: SparkSession, path: str, key: str, vector: str, questions: dict[str, list[float]], k: int, probes: int = 16, short: int = 20) -> DataFrame:
    """``(question, key, score, rank)``: the k best of the ``probes`` nearest cells of each question, by exact cosine of a short list.

    Codes cut each cell to ``short * k`` rows per question; only their vectors are read.
    """
    model = load_model(spark, path)
    names, coarse, books = list(questions), model["coarse"], model["books"]
    width = coarse.shape[1]
    parts = _slices(width, len(books))
    unit_q = _unit(np.array([questions[n] for n in names], dtype=np.float64))
    near = np.argsort(((coarse * coarse).sum(1) - 2 * (unit_q @ coarse.T)), axis=1, kind="stable")[:, :probes]
    wanted = {c: np.flatnonzero((near == c).any(1)) for c in np.unique(near).tolist()}
    index = spark.read.parquet(f"{path}/cells")
    kind = dict(index.dtypes)[key]
    # Score of a code: question times cell centre, plus one table entry for each part of the residual.
    tables = [unit_q[:, p] @ b.T for p, b in zip(parts, books)]
    centre, keep = unit_q @ coarse.T, short * k

    def shortlist(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.asarray(batch.column("cell"))
            codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(-1, len(books))
            for c in np.unique(cell).tolist():
                rows, asked = np.flatnonzero(cell == c), wanted[c]
                score = centre[asked, c][None, :] + sum(t[asked][:, codes[rows, i]].T for i, t in enumerate(tables))
                keys = batch.column(key).take(pa.array(rows))
                picks = _best_rows(score, np.asarray(keys.to_pandas()), keep)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([np.full(len(p), q) for p, q in zip(picks, asked)]).astype(np.int32)), keys.take(pa.array(np.concatenate(picks))),
                    pa.array(np.full(sum(map(len, picks)), c, np.int32)), pa.array(np.concatenate([score[p, j] for j, p in enumerate(picks)]))], names=["question", key, "cell", "near"])

    cells = [int(c) for c in wanted]
    codes = index.filter(F.col("cell").isin(cells)).select(key, "code", "cell").mapInArrow(shortlist, f"question int, {key} {kind}, cell int, near double")
    rank = F.row_number().over(Window.partitionBy("question").orderBy(F.desc("near"), key))
    listed = codes.withColumn("_r", rank).filter(F.col("_r") <= keep).select("question", key, "cell")
    exact = listed.join(index.filter(F.col("cell").isin(cells)).select(key, "cell", vector), ["cell", key])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = np.asarray(batch.column("question"))
            s = np.round((_unit(_matrix(batch.column(vector), width)) * unit_q[asked]).sum(1), 6)
            yield pa.RecordBatch.from_arrays([pa.array([names[q] for q in asked], pa.string()), batch.column(key), pa.array(s)], names=["question", key, "score"])

    scored = exact.select("question", key, vector).mapInArrow(score, f"question string, {key} {kind}, score double")
    last = F.row_number().over(Window.partitionBy("question").orderBy(F.desc("score"), key))
    return scored.withColumn("rank", last).filter(F.col("rank") <= k)


def sync(spark: SparkSession, path: str, key: str, vector: str, changes: DataFrame) -> list[int]:
    """Apply ``changes`` (key, vector, change_type; one row per key) and return the cells that were rewritten.

    Cells without a changed key are neither read for rewriting nor written. The new cells are written aside first, so that a
    run that fails can be run again.
    """
    index = spark.read.parquet(f"{path}/cells")
    staged = shared_dir(spark, "vector_changes")
    upserts = changes.filter("change_type <> 'delete'").select(key, vector)
    _placed(upserts, key, vector, load_model(spark, path)).write.parquet(staged)
    fresh = spark.read.parquet(staged)
    left = index.select(key, "cell").join(changes.select(key), key, "left_semi").select("cell")
    touched = sorted(r["cell"] for r in left.union(fresh.select("cell")).distinct().collect())  # at most the cells of the model
    if not touched:
        return touched
    kept = index.filter(F.col("cell").isin(touched)).join(changes.select(key), key, "left_anti")
    aside = shared_dir(spark, "vector_cells")
    kept.unionByName(fresh).write.parquet(aside)
    new = spark.read.parquet(aside)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        new.repartition("cell", F.xxhash64(key) % 8).write.mode("overwrite").partitionBy("cell").parquet(f"{path}/cells")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    gone = sorted(set(touched) - {r["cell"] for r in new.select("cell").distinct().collect()})
    for cell in gone:  # a cell that lost its last key
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/cells/cell={cell}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return touched
