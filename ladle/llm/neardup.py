"""Near duplicates with bottom-k sketches from one hash function.

1. Every text becomes its set of hashed word shingles; the sketch is the k smallest. Texts with equal sets are one node.
2. Inverted lists of sketch values: values in one node only are dropped; of the others a node keeps its rarest
   ``s - c + 1``, where c is the number of sketch values that two linked sets share except with probability ``MISS``. Any
   linked pair then meets in a list, and frequent values (common lines, passages) stay out of the lists.
3. No list is expanded into pairs. Each list is first compared with its most typical node, and what that links is merged, so
   a group of n copies costs about n comparisons. Nodes of lists that still hold several components get sketches of up to
   ``FINE`` values (whole sets, for most texts) and new lists by value and size, in which a value counts only if several components hold it: a
   text with more changes of its own than a link allows has too few of those and needs no comparison. These lists are
   compared with their most typical node again, and only pairs of one list that are still in different components are
   compared after that, so no link between components is lost.
4. Union sketches filter the pairs with the same bound; exact Jaccard of the full sets of shingle strings confirms.

Defined cases: a null or blank text has an empty set and is linked with nothing; a text with fewer than five words has its
whole sequence as one shingle; rows that share a doc_id are one vertex; a null doc_id is never linked and stays; extra
columns are ignored by :func:`classes` and kept by :func:`keep_one`; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.llm import common, graph

WIDTH, SKETCH, FINE, MISS = 5, 64, 1024, 1e-12
#: Size classes of the second lists grow by this factor.
STEP = 1.02
#: Bounds are tabulated up to this size of a set; larger sets use the last.
TABLE = 1024


def _shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys (document << 52 | hash) and the document of each."""
    low = common.lower_ascii(data)
    s, e, doc = common.word_spans(low, offsets, common.blank_table())
    h = common.span_hashes(low, s, e)
    n = np.bincount(doc, minlength=len(offsets) - 1)
    first = np.concatenate([[0], np.cumsum(n)])
    total = len(h)
    place = np.arange(total) - first[doc]
    mixed = np.zeros(total, np.uint64)
    for k in range(WIDTH):
        part = np.zeros(total, np.uint64)
        part[:max(0, total - k)] = h[k:]
        mixed = common.mix(mixed * np.uint64(0x100000001B3) + part + np.uint64(k)) if k < total else mixed
    whole = place + WIDTH <= n[doc]
    # A short text: its words from the first on, and their number.
    for d in np.flatnonzero((n > 0) & (n < WIDTH)):
        v = np.uint64(int(n[d]))
        for x in h[first[d]:first[d + 1]]:
            v = common.mix(v * np.uint64(0x100000001B3) + x + np.uint64(99))
        mixed[first[d]] = v
        whole[first[d]] = True
    key = (doc[whole].astype(np.uint64) << np.uint64(52)) | (mixed[whole] >> np.uint64(12))
    key.sort()
    if len(key):
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
    return key & np.uint64((1 << 52) - 1), (key >> np.uint64(52)).astype(np.int64)


def _sketch_task(k: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in common.slices(batch, "text"):
                with np.errstate(over="ignore"):
                    h, doc = _shingle_sets(data, offsets)
                    cut = np.searchsorted(doc, np.arange(end - first + 1))
                    spread = common.mix(h + np.uint64(0x5851F42D4C957F2D))
                    sums, xors = np.concatenate([[0], np.cumsum(spread, dtype=np.uint64)]).astype(np.uint64), []
                    for a, b in zip(cut, cut[1:]):
                        xors.append(int(np.bitwise_xor.reduce(common.mix(h[a:b]))) if b > a else 0)
                    total = sums[cut[1:]] - sums[cut[:-1]]
                    signed = h.astype(np.int64)
                    yield pa.RecordBatch.from_arrays([
                        batch.column("doc_id").slice(first, end - first).cast(pa.int64()), pa.array(np.diff(cut), pa.int64()),
                        pa.array([int(t).to_bytes(8, "big") + x.to_bytes(8, "big") for t, x in zip(total, xors)], pa.binary()),
                        pa.array([signed[a:min(b, a + k)] for a, b in zip(cut, cut[1:])], pa.list_(pa.int64()))],
                        names=["doc_id", "n_shingles", "digest", "sketch"])
    return task


def sketches(docs: DataFrame, k: int = SKETCH) -> DataFrame:
    return docs.select("doc_id", "text").mapInArrow(_sketch_task(k), "doc_id long, n_shingles long, digest binary, sketch array<long>")


@lru_cache
def shared_at_least(percent: int, k: int) -> tuple[int, ...]:
    """For sets of 0, 1, ..., TABLE or more shingles: the sketch values that any linked partner shares, except with probability MISS.

    Of the k smallest values of a union of size u, those in both sets are hypergeometric, and all of them are in both sketches.
    For the last entry, which holds for all larger sets, they count as binomial, whose lower tail is heavier.
    """
    def choose(n, r):
        return math.lgamma(n + 1) - math.lgamma(r + 1) - math.lgamma(n - r + 1)

    def lowest(hits, log_chance):
        p = 0.0
        for h in hits:
            p += math.exp(log_chance(h))
            if p > MISS:
                return h
        return hits[-1]

    def bound(u):
        both, drawn = -(-percent * u // 100), min(k, u)
        hits = range(max(0, drawn - (u - both)), min(drawn, both) + 1)
        return lowest(hits, lambda h: choose(both, h) + choose(u - both, drawn - h) - choose(u, drawn))

    share = percent / 100
    widest = lowest(range(k + 1), lambda h: choose(k, h) + h * math.log(share) + (k - h) * math.log1p(-share)) if share < 1 else k
    cache = {u: bound(u) for u in range(1, TABLE * 100 // percent + 2)}
    exact = tuple(max(1, min(cache[u] for u in {n, (n + n * 100 // percent) // 2, n * 100 // percent})) for n in range(1, TABLE))
    return (0, *exact, widest)


def _bound(n: Column, percent: int, k: int) -> Column:
    return F.get(F.lit(list(shared_at_least(percent, k))), F.least(n, F.lit(TABLE)).cast("int"))


def _pairs_linked(pairs: DataFrame, sk: DataFrame, texts: DataFrame, percent: int, k: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full shingle sets meet the bound."""
    one, two = (sk.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}")) for c in "ab")
    near = pairs.join(one, "a").filter("na > 0").join(two, "b").filter((F.col("na") * 100 >= F.col("nb") * percent) & (F.col("nb") * 100 >= F.col("na") * percent))
    # Sketches that hold their whole sets give the similarity itself.
    both, either = F.size(F.array_intersect("sa", "sb")), F.size(F.array_union("sa", "sb"))
    hits = F.size(F.array_intersect(F.array_intersect("sa", "sb"), F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)))
    few = F.greatest(_bound(F.col("na"), percent, k), _bound(F.col("nb"), percent, k))
    near = near.filter(F.when(F.greatest("na", "nb") <= k, both * 100 >= either * percent).otherwise(hits >= few)).select("a", "b")
    near = common.stage(near, "near")
    full = near.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a").join(
        texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
    return common.stage(full.mapInArrow(_verify_task(percent), "a long, b long").distinct(), "linked")


def shingle_strings(text: bytes) -> set[bytes]:
    words = text.translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))).split()
    if len(words) < WIDTH:
        return {b" ".join(words)} if words else set()
    return {b" ".join(words[i:i + WIDTH]) for i in range(len(words) - WIDTH + 1)}


def _verify_task(percent: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, set()
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            ta, tb = batch.column("ta").cast(pa.binary()), batch.column("tb").cast(pa.binary())
            good = []
            for i in range(batch.num_rows):
                text = ta[i].as_py() or b""
                if text != last:
                    last, known = text, shingle_strings(text)
                other = shingle_strings(tb[i].as_py() or b"")
                shared = len(known & other)
                if shared and 100 * shared >= percent * (len(known) + len(other) - shared):
                    good.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in good], pa.int64()), pa.array([b[i] for i in good], pa.int64())], names=["a", "b"])
    return task


def _crossing(sk: DataFrame, crossing: Column) -> DataFrame:
    """The nodes with ``v``, their sketch values of which ``crossing`` holds, rarest first, and ``typical``, how frequent those are."""
    values = sk.select("node", "label", "n", F.explode("sketch").alias("value"))
    # A table of its own, so that both sides of the join below are plain shuffles and a frequent value can be split.
    often = common.stage(values.groupBy("value").agg(F.count("*").alias("df"), crossing.alias("crossing")).filter("crossing").select("value", "df"), "often")
    per_node = values.join(often, "value").groupBy("node", "label", "n").agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("v"))
    return per_node.withColumn("typical", F.aggregate("v", F.lit(0).cast("long"), lambda t, x: t + x["df"]))


def _lists(sk: DataFrame, percent: int, k: int) -> DataFrame:
    """(value, node, label, n, typical): a node is in the lists of the rarest of its values that other nodes have too.

    Each linked partner shares c values of the sketch, so it is met in the rarest s - c + 1, and the places of the values
    that no other node has come first. A node with fewer than c shared values has no partner and is in no list.
    """
    prefix = F.size("v") - _bound(F.col("n"), percent, k) + 1
    lists = _crossing(sk, F.count("*") > 1).withColumn("prefix", prefix).filter("prefix > 0")
    lists = lists.select("node", "label", "n", "typical", F.explode(F.slice("v", 1, F.col("prefix"))).alias("x"))
    return common.stage(lists.select(F.col("x.value").alias("value"), "node", "label", "n", "typical"), "lists")


def _fine_lists(sk: DataFrame, percent: int, k: int) -> DataFrame:
    """As :func:`_lists`, of values that several labels hold, split by size of the smaller set: ``value`` stands for both.

    Linked sets of sizes a <= b share percent / (100 + percent) * (a + b) shingles. So a set is ``small`` in the lists of its
    own size class, with the bound for an equal partner, and not ``small`` in those of each class that a smaller partner
    may have, with the bound for that class. ``most`` is the largest number of shingles that any partner can share. Where one
    of the two may be larger than its sketch, the bound of the sketches takes the place of the count.
    """
    n, whole = F.col("n"), percent + 100
    size_class = lambda x: F.floor(F.log(x) / math.log(STEP)).cast("int")
    least = F.ceil(n * percent / 100)
    share = lambda other: F.ceil((n + other) * percent / whole - 1e-6)
    smaller = F.transform(F.sequence(size_class(least), size_class(n)), lambda g: F.struct(
        g.alias("g"), F.lit(False).alias("small"),
        F.when(n <= k, share(F.greatest(least, F.floor(F.pow(F.lit(STEP), g))))).otherwise(_bound(n, percent, k)).cast("int").alias("c")))
    own = F.array(F.struct(size_class(n).alias("g"), F.lit(True).alias("small"),
                           F.when(n * 100 <= k * percent, share(n)).otherwise(_bound(n, percent, k)).cast("int").alias("c")))
    places = _crossing(sk, F.min("label") < F.max("label")).select(
        "node", "label", "n", "typical", "v", F.when(n <= k, F.size("v")).otherwise(n).alias("most"), F.explode(F.concat(own, smaller)).alias("p"))
    lists = places.withColumn("prefix", F.size("v") - F.col("p.c") + 1).filter("prefix > 0").select(
        "node", "label", "n", "typical", "most", "p.g", "p.small", F.explode(F.slice("v", 1, F.col("prefix"))).alias("x"))
    return common.stage(lists.select(F.xxhash64("x.value", "g").alias("value"), "node", "label", "n", "typical", "most", "small"), "lists")


def _stars(lists: DataFrame) -> DataFrame:
    """Pairs (a, b) of each list's most typical node with those of other labels."""
    centres = lists.groupBy("value").agg(F.max(F.struct("typical", -F.col("node"), "label")).alias("c"), F.count("*").alias("size")).filter("size > 1").select(
        "value", (-F.col("c.col2")).alias("a"), F.col("c.label").alias("la"))
    return lists.join(centres, "value").filter("node <> a AND label <> la").select("a", F.col("node").alias("b")).distinct()


def _relabel(lists: DataFrame, label: DataFrame) -> DataFrame:
    """``lists`` with the labels of components of nodes, and only where they still hold several."""
    old = lists.drop("label").join(label.select("node", "label"), "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = old.groupBy("value").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("value")
    return common.stage(old.join(mixed, "value"), "mixed")


def classes(docs: DataFrame, percent: int = 85, k: int = SKETCH, fine: int = FINE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each input row."""
    each = common.stage(sketches(docs, k), "sketches")
    # A node is one distinct set, named by its smallest doc_id.
    nodes = each.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("digest", "n_shingles").agg(F.min("doc_id").alias("node"))
    nodes = common.stage(nodes, "nodes")
    sk = each.join(nodes.select("digest", F.col("node").alias("doc_id")), ["digest", "doc_id"]).select(
        F.col("doc_id").alias("node"), F.col("doc_id").alias("label"), F.col("n_shingles").alias("n"), "sketch").dropDuplicates(["node", "n", "sketch"])
    sk = common.stage(sk, "node_sketches")
    lists = _lists(sk, percent, k)
    stars = common.stage(_stars(lists), "stars")
    involved = stars.select("a").union(stars.select("b")).toDF("doc_id").distinct()
    texts = common.stage(docs.select("doc_id", "text").join(involved, "doc_id").distinct(), "texts")
    linked = _pairs_linked(stars, sk, texts, percent, k)
    # Lists that still hold several components: their nodes get larger sketches, and a value counts only where components share it.
    mixed = _relabel(lists, graph.components(linked)).groupBy("node", "label").agg(F.max("n").alias("n"))
    again = sketches(texts.join(mixed.select(F.col("node").alias("doc_id")), "doc_id"), fine)
    sk = common.stage(again.select(F.col("doc_id").alias("node"), "sketch").dropDuplicates(["node", "sketch"]).join(mixed, "node"), "fine_sketches")
    lists = _fine_lists(sk, percent, fine)
    stars = common.stage(_stars(lists), "stars")
    linked = linked.union(_pairs_linked(stars, sk, texts, percent, fine))
    left = _relabel(lists, graph.components(linked))
    one, two = (left.filter(f"small = {c == 'a'}").select("value", *[F.col(x).alias(f"{x}_{c}") for x in ("node", "label", "n", "most")]) for c in "ab")
    rest = one.join(two, "value").filter((F.col("label_a") != F.col("label_b")) & (F.col("n_a") <= F.col("n_b")) & (F.col("n_a") * 100 >= F.col("n_b") * percent) & (
        F.least("most_a", "most_b") * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent))
    rest = common.stage(rest.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct(), "rest")
    # Pairs with a centre are known already.
    rest = rest.join(stars, ["a", "b"], "left_anti").join(stars.toDF("b", "a"), ["a", "b"], "left_anti")
    label = graph.components(linked.union(_pairs_linked(rest, sk, texts, percent, fine)))
    named = nodes.join(label, "node", "left").select("digest", "n_shingles", F.coalesce("label", "node").alias("label"))
    out = each.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest")).join(
        named, ["digest", "n_shingles"], "left")
    component = F.coalesce("label", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, percent: int = 80, k: int = SKETCH) -> DataFrame:
    """One document of each component stays, the one with the smallest id, with all its columns; so do rows with a null id.

    Different texts under one id are different documents: all but one of them take part under numbers beyond 2**62 made of a hash
    of id and text, so each goes only if it is a near duplicate itself. Of fully equal ids and texts one row stays.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.coalesce(F.col("row.text"), F.lit(""))
    rows = rows.select("row", F.col("row.doc_id").cast("long").alias("id"), F.xxhash64(text).alias("key"))
    several = common.stage(rows.filter("id IS NOT NULL").groupBy("id").agg(F.min("key").alias("first"), F.max("key").alias("last")).filter("first <> last").select("id", "first"), "several")
    if several.isEmpty():
        rows = rows.withColumn("node", F.col("id"))
    else:
        other = F.shiftrightunsigned(F.xxhash64("id", F.col("row.text")), 2) + F.lit(1 << 62)
        rows = rows.join(several, "id", "left").withColumn("node", F.when(F.col("first").isNull() | (F.col("first") == F.col("key")), F.col("id")).otherwise(other))
    gone = classes(rows.select(F.col("node").alias("doc_id"), F.col("row.text").alias("text")), percent, k).filter("NOT kept").select(F.col("doc_id").alias("node")).distinct()
    rows = rows.join(gone, "node", "left_anti")
    named = rows.filter("node IS NOT NULL").groupBy("node").agg(F.min("row").alias("row")).select("row.*")
    return named.unionByName(rows.filter("node IS NULL").select("row.*"))
