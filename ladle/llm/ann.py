"""Approximate nearest neighbours on robust-pruned directed graphs.

Distinct vectors are dealt by hash into shards of about ``SHARD`` and each shard builds one graph: points are inserted in
batches, a greedy search on the graph so far proposes their neighbours, and relaxed pruning keeps an edge only if no kept
edge leads to a point that is ALPHA times nearer to its end. Inner product becomes distance by one more coordinate
that gives all points of a shard the same norm. Queries go through a beam search on every shard; the best of all
shards are merged. Scores are inner products of the original vectors in double precision.

Equal vectors are one point that carries its k + 1 smallest ids: no answer can hold more of them. Points that no search
could reach get an edge from their nearest reachable point.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and rows without an id, take no
part; a repeated vec_id counts once, with its smallest vector; vectors only meet vectors of their own length; ties go to the
smaller vec_id; with fewer than k candidates all are returned; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ladle.llm import common

SHARD, DEGREE, BUILD_BEAM, ALPHA = 16384, 32, 64, 1.2
BEAM = 128


def usable(v: Column) -> Column:
    fine = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return v.isNotNull() & (F.size(v) > 0) & fine & F.exists(v, lambda x: x != 0)


class Graph:
    """A directed graph over the rows of ``points``; -1 fills unused places of ``edges``."""

    def __init__(self, points: np.ndarray, edges: np.ndarray, entry: int):
        self.points, self.edges, self.entry = points, edges, entry

    def search(self, queries: np.ndarray, beam: int, squares: np.ndarray | None = None, stride: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """Beam search for all queries at once: (ids, costs), nearest first; -1 where fewer were found.

        The cost is squared distance less the query's own square if ``squares`` has the squares of the points, else minus the
        inner product.
        """
        n, q = len(self.points), len(queries)
        width = min(beam, n)

        def cost(ids):
            dots = np.einsum("qcd,qd->qc", self.points[np.maximum(ids, 0)], queries)
            return np.where(ids < 0, np.inf, -dots if squares is None else squares[np.maximum(ids, 0)] - 2 * dots).astype(np.float32)

        ids = np.full((q, width), -1, np.int64)
        ids[:, 0] = self.entry
        costs = np.full((q, width), np.inf, np.float32)
        costs[:, 0] = cost(ids[:, :1])[:, 0]
        done = np.zeros((q, width), bool)
        seen = np.zeros((q, n + 1), bool)
        seen[:, self.entry] = True
        rows = np.arange(q)
        while len(rows):
            open_ = np.where(done[rows] | (ids[rows] < 0), np.inf, costs[rows])
            take = np.argsort(open_, axis=1)[:, :stride]
            valid = np.take_along_axis(open_, take, 1) < np.inf
            going = valid.any(1)
            rows, take, valid = rows[going], take[going], valid[going]
            if not len(rows):
                break
            done[rows[:, None], take] |= valid
            at = np.where(valid, ids[rows[:, None], take], -1)
            near = np.where(at[:, :, None] >= 0, self.edges[np.maximum(at, 0)], -1).reshape(len(rows), -1)
            near = np.where(seen[rows[:, None], near], -1, near)
            near.sort(axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            seen[rows[:, None], near] = True
            seen[rows, -1] = False
            near = -np.sort(-near, axis=1)
            near = near[:, :max(1, int((near >= 0).sum(1).max()))]
            dots = np.einsum("qcd,qd->qc", self.points[np.maximum(near, 0)], queries[rows])
            fresh = np.where(near < 0, np.inf, -dots if squares is None else squares[np.maximum(near, 0)] - 2 * dots)
            all_ids, all_costs = np.concatenate([ids[rows], near], 1), np.concatenate([costs[rows], fresh], 1).astype(np.float32)
            all_done = np.concatenate([done[rows], np.zeros(near.shape, bool)], 1)
            best = np.argsort(all_costs, axis=1, kind="stable")[:, :width]
            ids[rows], costs[rows], done[rows] = (np.take_along_axis(x, best, 1) for x in (all_ids, all_costs, all_done))
        return np.where(costs < np.inf, ids, -1), costs


def prune(points: np.ndarray, at: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each point ``at``, up to ``degree`` of its candidates (-1: none) that relaxed pruning keeps."""
    own = points[at]
    candidates = np.where(candidates == at[:, None], -1, candidates)
    there = points[np.maximum(candidates, 0)]
    far = np.where(candidates < 0, np.inf, ((there - own[:, None]) ** 2).sum(2))
    squares = (there ** 2).sum(2)
    between = squares[:, :, None] + squares[:, None, :] - 2 * np.matmul(there, there.transpose(0, 2, 1))
    left, out = far.copy(), np.full((len(at), degree), -1, np.int64)
    rows = np.arange(len(at))
    for k in range(degree):
        best = left.argmin(1)
        ok = left[rows, best] < np.inf
        if not ok.any():
            break
        out[ok, k] = candidates[rows, best][ok]
        covered = alpha * alpha * between[rows, best] <= far
        left[covered & ok[:, None]] = np.inf
        left[rows, best] = np.inf
    return out


def build(vectors: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA) -> Graph:
    norms = (vectors.astype(np.float64) ** 2).sum(1)
    lift = np.sqrt(np.maximum(norms.max() - norms, 0))
    points = np.concatenate([vectors, lift[:, None]], 1).astype(np.float32)
    squares = (points ** 2).sum(1)
    n = len(points)
    order = np.random.default_rng(1).permutation(n)
    entry = int(((points - points.mean(0)) ** 2).sum(1).argmin())
    order = np.concatenate([[entry], order[order != entry]])
    wide = degree + degree // 2
    graph = Graph(points, np.full((n, wide), -1, np.int64), entry)
    edges, size, at = graph.edges, 32, 1
    while at < n:
        part = order[at:at + size]
        found, _ = graph.search(points[part], beam, squares)
        # Points of one batch cannot find each other in the graph yet: offer them the nearest of their own batch.
        dist = squares[part][None, :] - 2 * points[part] @ points[part].T
        np.fill_diagonal(dist, np.inf)
        mates = part[np.argsort(dist, axis=1)[:, :min(16, max(1, len(part) - 1))]] if len(part) > 1 else np.full((1, 1), -1)
        edges[part, :degree] = prune(points, part, np.concatenate([found, mates], 1), degree, alpha)
        source, place = np.nonzero(edges[part, :degree] >= 0)
        target, source = edges[part][source, place], part[source]
        by = np.argsort(target, kind="stable")
        target, source = target[by], source[by]
        heads, starts, counts = np.unique(target, return_index=True, return_counts=True)
        new = np.full((len(heads), counts.max()), -1, np.int64)
        new[np.repeat(np.arange(len(heads)), counts), np.arange(len(target)) - np.repeat(starts, counts)] = source
        have = edges[heads]
        new[(new[:, :, None] == have[:, None, :]).any(2)] = -1
        merged = -np.sort(-np.concatenate([have, new], 1), axis=1)
        degrees = (merged >= 0).sum(1)
        light = degrees <= wide
        edges[heads[light]] = merged[light][:, :wide] if merged.shape[1] >= wide else np.pad(merged[light], ((0, 0), (0, wide - merged.shape[1])), constant_values=-1)
        heavy = np.flatnonzero(~light)
        for cut in np.array_split(heavy, max(1, len(heavy) // 128)):
            if len(cut):
                edges[heads[cut]] = -1
                edges[heads[cut], :degree] = prune(points, heads[cut], merged[cut], degree, alpha)
        at += len(part)
        size = min(256, size * 2)
    return _reach_all(graph)


def _reach_all(graph: Graph) -> Graph:
    n = len(graph.points)
    while True:
        reached, new = np.zeros(n, bool), np.array([graph.entry])
        while len(new):
            reached[new] = True
            new = np.unique(graph.edges[new])
            new = new[(new >= 0)]
            new = new[~reached[new]]
        lost = np.flatnonzero(~reached)
        if not len(lost):
            return graph
        # Attach the lost points one layer at a time: at least one of them becomes reachable in every round.
        known = np.flatnonzero(reached)
        parents = np.concatenate([known[(((graph.points[known] ** 2).sum(1))[None, :] - 2 * graph.points[part] @ graph.points[known].T).argmin(1)]
                                  for part in np.array_split(lost, max(1, len(lost) // 256))])
        order = np.argsort(parents, kind="stable")
        parents, lost = parents[order], lost[order]
        _, starts, counts = np.unique(parents, return_index=True, return_counts=True)
        place = np.arange(len(lost)) - np.repeat(starts, counts)
        more = np.full((n, int(counts.max())), -1, np.int64)
        more[parents, place] = lost
        graph.edges = np.concatenate([graph.edges, more], 1)


def _build_task(table: pa.Table) -> pa.Table:
    vectors = np.asarray(table.column("vector").combine_chunks().flatten(), np.float32).reshape(table.num_rows, -1)
    graph = build(vectors)
    return pa.table({
        "dim": pa.array([vectors.shape[1]], pa.int32()), "shard": table.column("shard").slice(0, 1).cast(pa.int32()), "points": pa.array([vectors.tobytes()], pa.binary()),
        "edges": pa.array([graph.edges.astype(np.int32).tobytes()], pa.binary()), "entry": pa.array([graph.entry], pa.int32()),
        "members": pa.array([table.column("ids").to_pylist()], pa.list_(pa.list_(pa.int64())))})


def _search_task(k: int, beam: int):
    """Rows come by shard, its graph before the queries that visit it."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, members = None, []
        for batch in batches:
            heads = np.flatnonzero(np.asarray(batch.column("points").is_valid()))
            for lo, hi in zip([0, *heads.tolist()], [*heads.tolist(), batch.num_rows]):
                if lo == hi:
                    continue
                if lo in heads:
                    r = batch.slice(lo, 1).to_pylist()[0]
                    points = np.frombuffer(r["points"], np.float32).reshape(-1, r["dim"])
                    graph = Graph(points, np.frombuffer(r["edges"], np.int32).reshape(len(points), -1).astype(np.int64), r["entry"])
                    members = r["members"]
                    lo += 1
                for at in range(lo, hi, 256):
                    part = batch.slice(at, min(256, hi - at))
                    own = part.column("query_id").to_pylist()
                    queries = np.asarray(part.column("query").flatten(), np.float32).reshape(len(own), -1)
                    ids, _ = graph.search(queries, beam)
                    ids = ids[:, :k + 1]
                    exact = np.einsum("qcd,qd->qc", graph.points[np.maximum(ids, 0)].astype(np.float64), queries.astype(np.float64))
                    rows = []
                    for q, found, scores in zip(own, ids, exact):
                        hits = sorted((-s, v) for i, s in zip(found.tolist(), scores.tolist()) if i >= 0 for v in members[i] if v != q)[:k]
                        rows += [(q, v, -s) for s, v in hits]
                    if rows:
                        a, b, c = zip(*rows)
                        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.float64())], names=["query_id", "vec_id", "score"])
    return task


def _clean(vectors: DataFrame) -> DataFrame:
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>").alias("vector"))
    return v.filter(F.col("vec_id").isNotNull() & usable(F.col("vector"))).groupBy("vec_id").agg(F.min("vector").alias("vector"))


def index(vectors: DataFrame, k: int, shard: int = SHARD) -> DataFrame:
    """One row for each graph: dim, shard, points, edges, entry, members."""
    rank = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    few = _clean(vectors).withColumn("_k", rank).filter(F.col("_k") <= k + 1)
    points = common.stage(few.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn("dim", F.size("vector")), "points")
    shards = points.groupBy("dim").agg(F.ceil(F.count("*") / shard).cast("int").alias("shards"))
    dealt = points.join(shards, "dim").withColumn("shard", F.pmod(F.xxhash64("vector"), F.col("shards")).cast("int"))
    # A graph takes minutes and its rows few bytes: left to sizes, a small table's graphs would all be built in one task.
    tasks = 2 * (shards.agg(F.sum("shards")).first()[0] or 1)
    return common.stage(dealt.select("dim", "shard", "vector", "ids").repartition(tasks, "dim", "shard").groupBy("dim", "shard").applyInArrow(
        _build_task, "dim int, shard int, points binary, edges binary, entry int, members array<array<bigint>>"), "graphs")


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, beam: int = BEAM, shard: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every query (rows like ``vectors``)."""
    graphs = index(vectors, k, shard)
    asked = _clean(queries).select(F.size("vector").alias("dim"), F.col("vec_id").alias("query_id"), F.col("vector").alias("query"))
    # Every query visits every shard of its length. A graph travels once, ahead of its visitors, however many they are.
    shards = graphs.groupBy("dim").agg(F.collect_set("shard").alias("shards"))
    visits = asked.join(shards, "dim").withColumn("shard", F.explode("shards")).drop("shards")
    flow = graphs.unionByName(visits, allowMissingColumns=True).repartition(2 * max(1, graphs.count()), "dim", "shard").sortWithinPartitions(
        "dim", "shard", F.col("points").isNull())
    found = flow.mapInArrow(_search_task(k, beam), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
