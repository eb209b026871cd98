"""Removal of repeated byte strings with a sparse, range-partitioned suffix array.

A string of ``SPAN`` bytes counts as repeated if it starts at two places or more. Sorting every suffix of the corpus would move
a multiple of it, so suffixes start at anchors only: in each window of SPAN bytes the anchor is the leftmost place whose
GRAM bytes have the smallest hash. Equal windows have their anchors at equal places, so comparing windows means comparing,
around anchors, what follows (the suffix) and what precedes. A unit is an anchor with all windows that chose it.

1. Anchors whose GRAM bytes occur once in the corpus are dropped; no window of theirs is repeated.
2. Units with equal bytes are one unit with a count.
3. Sampled splitters range-partition the units by suffix and then by the reversed text before the anchor, so that a suffix
   of any frequency is split too; the number of buckets follows the number of units. Every bucket sorts its suffixes, and the reversed texts
   before the anchors, by multikey quicksort on words of eight bytes, which also yields the common prefixes. Two windows at
   the same distance from their anchors are equal if both common prefixes are long enough.
4. Where a suffix shares enough bytes with a splitter next to it, its class may reach over the boundary: such windows are
   compared across buckets by digest, in an aggregate that combines on the map side. Before that, such units are compared by
   their GRAM bytes with the last 12, 24, 36, ... bytes before: windows that reach farther left than any other unit goes along
   have no partner and need no digest. So many texts before one hot passage cost a few digests each.

Everything is judged on the input texts. Texts are named by a 64-bit hash, so repeated rows and null or repeated ids do no
harm. Defined cases: a null text is empty; texts shorter than SPAN keep all bytes; extra columns are ignored; an empty table
gives an empty result. Sampled units are all that reaches the driver, SAMPLE of at most SPAN + REACH bytes for each bucket.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm import common

SPAN, GRAM = 200, 48
REACH = SPAN - GRAM  # an anchor lies at most so far behind the start of its window
BUCKET_UNITS, SAMPLE = 20_000, 20
#: Distances before the anchor at which units with windows in several buckets are compared first.
LADDER = tuple(range(12, REACH + 1, 12))


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of every run of windows with one anchor: document, anchor, distance of the first and last window, hash of the gram."""
    none = np.zeros(0, np.int64)
    if len(data) < SPAN:
        return none, none, none, none, none
    gram = common.span_hashes(data, np.arange(len(data) - GRAM + 1), np.arange(GRAM, len(data) + 1))
    least = (gram & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(gram), dtype=np.uint64)
    cover = 1
    while cover * 2 <= REACH + 1:
        least = np.minimum(least[:-cover], least[cover:])
        cover *= 2
    rest = REACH + 1 - cover
    least = np.minimum(least[:-rest], least[rest:]) if rest else least
    size = np.diff(offsets)
    long = np.flatnonzero(size >= SPAN)
    windows = size[long] - SPAN + 1
    if not len(long):
        return none, none, none, none, none
    doc = np.repeat(long, windows)
    start = np.arange(len(doc)) - np.repeat(np.cumsum(windows) - windows, windows) + offsets[doc]
    at = (least[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.concatenate([[True], (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(at)]]) - 1
    p = at[first]
    return doc[first], p - offsets[doc[first]], p - start[first], p - start[last], gram[p].astype(np.int64)


def _anchor_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = np.array(batch.column("key"))
        for first, _, data, offsets in common.slices(batch, "text", 1_000_000):
            doc, at, far, near, gram = anchors(data, offsets)
            yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(keys[first + doc]), pa.array((at << 16) | (far << 8) | near)], names=["gram", "key", "place"])


def _unit_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of a unit travel with its first occurrence in a task only."""
    known: set[bytes] = set()
    for batch in batches:
        out: list[tuple] = []
        texts = batch.column("text").cast(pa.binary())
        for key, text, places in zip(batch.column("key").to_pylist(), texts, batch.column("places").to_pylist()):
            data = text.as_py() or b""
            for place in places:
                at, far, near = place >> 16, (place >> 8) & 255, place & 255
                part = data[at - far:at - near + SPAN]
                uid = hashlib.blake2b(part, digest_size=16, salt=bytes([far])).digest()
                out.append((uid, key, place, far, None if uid in known else part))
                if len(known) > 500_000:
                    known.clear()
                known.add(uid)
        cols = list(zip(*out)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                                         names=["uid", "key", "place", "far", "part"])


def multikey_sort(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows, and the bytes that each shares with the one before; groups of equal words go on to the next word."""
    n, depth = words.shape
    order, shared = np.arange(n), np.zeros(n, np.int64)
    group, active = np.zeros(n, np.int64), np.arange(n)
    for c in range(depth):
        rows = order[active]
        by = np.lexsort((words[rows, c], group[active]))
        rows = rows[by]
        order[active] = rows
        own = group[active]
        here = words[rows, c]
        apart = own[1:] == own[:-1]
        differ = apart & (here[1:] != here[:-1])
        x = here[1:][differ] ^ here[:-1][differ]
        same = sum((x < np.uint64(1 << (64 - 8 * k))).astype(np.int64) for k in range(1, 8))
        shared[active[1:][differ]] = c * 8 + same
        tied = apart & ~differ
        fresh = np.concatenate([[True], ~tied])
        number = np.cumsum(fresh) - 1
        group[active] = number
        keep = np.zeros(len(active), bool)
        keep[1:] |= tied
        keep[:-1] |= tied
        if c + 1 == depth:
            shared[active[1:][tied]] = depth * 8
        active = active[keep]
        if not len(active):
            break
    return order, shared


def _words(strings: list[bytes], size: int) -> np.ndarray:
    flat = np.frombuffer(b"".join(s.ljust(size, b"\0") for s in strings), ">u8")
    return flat.astype(np.uint64).reshape(len(strings), size // 8)


def _common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid)
    return lo


def _sides(part: bytes, far: int) -> tuple[bytes, bytes]:
    """What follows from the anchor on, and the reversed text before it; units are sorted by both."""
    return part[far:], part[far - 1::-1] if far else b""


def _bucket_of(splitters: list[tuple[bytes, bytes]]):
    """Adds the bucket, and how many bytes the suffix shares with the splitters next to it: no more with any in other buckets."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from bisect import bisect_right

        for batch in batches:
            buckets, touch = [], []
            for far, part in zip(batch.column("far").to_pylist(), batch.column("part").to_pylist()):
                sides = _sides(part, far)
                b = bisect_right(splitters, sides)
                buckets.append(b)
                touch.append(max((_common_prefix(sides[0], e) for e, _ in splitters[max(0, b - 1):b + 1]), default=0))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(buckets, pa.int32()), pa.array(touch, pa.int32())], names=[*batch.schema.names, "bucket", "touch"])
    return task


def _ladder_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the GRAM bytes and the last LADDER bytes before them."""
    for batch in batches:
        rows = []
        for uid, far, part in zip(*(batch.column(c).to_pylist() for c in ("uid", "far", "part"))):
            for x in LADDER:
                if x > far:
                    break
                rows.append((uid, x, hashlib.blake2b(part[far - x:far + GRAM], digest_size=16, salt=bytes([x])).digest()))
        cols = list(zip(*rows)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.int32(), pa.binary()))], names=["uid", "x", "rung"])


def _alone_from(dealt: DataFrame) -> DataFrame:
    """(uid, alone): the least distance from which on no window of the unit has a partner in another bucket.

    A partner would have the same bytes at that distance, and touch a splitter as well.
    """
    rungs = dealt.filter(f"touch >= {SPAN} - far").select("uid", "far", "part").mapInArrow(_ladder_task, "uid binary, x int, rung binary")
    single = rungs.groupBy("rung").agg(F.count("*").alias("c"), F.min("uid").alias("uid"), F.min("x").alias("x")).filter("c = 1")
    return single.groupBy("uid").agg(F.min("x").alias("alone"))


_FOUND = "uid binary, first int, last int, window binary, n long"


def _bucket_task():
    def task(table: pa.Table) -> pa.Table:
        uid, far = table.column("uid").to_pylist(), np.array(table.column("far"))
        parts, n = table.column("part").to_pylist(), np.array(table.column("n"))
        size = len(parts)
        touch, alone = np.array(table.column("touch")), np.array(table.column("alone"))
        rights, lefts = zip(*map(_sides, parts, far.tolist()))
        near = SPAN - np.array([len(r) for r in rights])
        orders = []
        for strings, width in ((rights, SPAN), (lefts, REACH)):
            order, shared = multikey_sort(_words(strings, width))
            place = np.empty(size, np.int64)
            place[order] = np.arange(size)
            orders.append((place, shared))
        (r_place, r_shared), (l_place, l_shared) = orders
        repeated = np.zeros((size, REACH + 3), bool)
        over = []
        for x in range(REACH + 1):
            has = (near <= x) & (x <= far)
            own = np.flatnonzero(has)
            if len(own):
                right, left = np.cumsum(r_shared < SPAN - x)[r_place[own]], np.cumsum(l_shared < x)[l_place[own]]
                _, lead, same = np.unique(right * (size + 1) + left, return_index=True, return_inverse=True)
                total = np.bincount(same, n[own])
                repeated[own, x + 1] = total[same] >= 2
                # One window speaks for its class where the class may go on in other buckets.
                over += [(u, x, t) for u, t in zip(own[lead].tolist(), total.tolist()) if touch[u] >= SPAN - x and x < alone[u]]
        step = np.diff(repeated.astype(np.int8), axis=1)
        u, first = np.nonzero(step == 1)
        _, last = np.nonzero(step == -1)
        windows = [hashlib.blake2b(parts[u][far[u] - x:far[u] - x + SPAN], digest_size=16).digest() for u, x, _ in over]
        return pa.table({
            "uid": pa.array([uid[i] for i in u] + [uid[i] for i, _, _ in over], pa.binary()), "first": pa.array(first.tolist() + [x for _, x, _ in over], pa.int32()),
            "last": pa.array((last - 1).tolist() + [x for _, x, _ in over], pa.int32()), "window": pa.array([None] * len(u) + windows, pa.binary()),
            "n": pa.array([0] * len(u) + [int(t) for _, _, t in over], pa.int64())})
    return task


def _cut_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        texts = batch.column("text").cast(pa.binary())
        for text, spans in zip(texts, batch.column("spans").to_pylist()):
            data, kept, at, end, runs, removed = text.as_py() or b"", hashlib.sha256(), 0, -1, 0, 0
            for s in sorted((v["s"], v["e"]) for v in spans or ()):
                if s[0] > end:
                    runs += 1
                    kept.update(data[at:s[0]])
                    removed += s[1] - s[0]
                else:
                    removed += max(0, s[1] - end)
                end = at = max(end, s[1])
            kept.update(data[at:])
            rows.append((len(data), removed, runs, kept.hexdigest()))
        cols = list(zip(*rows)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())],
                                         names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    spark = docs.sparkSession
    named = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))
    place = named.select("key", "text").mapInArrow(_anchor_task, "gram long, key long, place long")
    # A table of its own, so that both sides of the join below are plain shuffles and a frequent gram can be split.
    often = common.stage(place.groupBy("gram").agg(F.count("*").alias("c")).filter("c > 1").select("gram"), "often")
    wanted = common.stage(place.join(often, "gram").groupBy("key").agg(F.collect_set("place").alias("places")), "places")
    units = common.stage(named.select("key", "text").join(wanted, "key").select("key", "text", "places").mapInArrow(
        _unit_task, "uid binary, key long, place long, far int, part binary"), "units")
    distinct = common.stage(units.groupBy("uid").agg(F.count("*").alias("n"), F.max("far").alias("far"), F.max("part").alias("part")), "distinct")
    total = distinct.count()
    buckets = max(1, -(-total // BUCKET_UNITS))
    taken = distinct.select("far", "part").sample(min(1.0, SAMPLE * buckets / max(total, 1)), seed=3).collect() if buckets > 1 else []
    sampled = sorted(_sides(bytes(r["part"]), r["far"]) for r in taken)
    splitters = sorted({sampled[len(sampled) * i // buckets] for i in range(1, buckets)}) if sampled else []
    dealt = distinct.mapInArrow(_bucket_of(splitters), "uid binary, n long, far int, part binary, bucket int, touch int")
    if splitters:
        dealt = dealt.join(common.stage(_alone_from(dealt), "alone"), "uid", "left").select(*dealt.columns, F.coalesce("alone", F.lit(SPAN)).alias("alone"))
    else:
        dealt = dealt.select("*", F.lit(SPAN).alias("alone"))
    found = common.stage(dealt.groupBy("bucket").applyInArrow(_bucket_task(), _FOUND), "found")
    across = found.filter("window IS NOT NULL")
    twice = across.groupBy("window").agg(F.sum("n").alias("total")).filter("total > 1").select("window")
    # Where a class has several windows in its bucket, the bucket has decided; the others ask what all buckets found.
    runs = found.filter("window IS NULL").select("uid", "first", "last").unionByName(across.filter("n = 1").join(twice, "window").select("uid", "first", "last"))
    at = F.shiftright("place", 16)
    spans = units.select("uid", "key", "place").distinct().join(runs, "uid").select(
        "key", F.struct((at - F.col("last")).alias("s"), (at - F.col("first") + SPAN).alias("e")).alias("v")).groupBy("key").agg(F.collect_list("v").alias("spans"))
    return named.join(spans, "key", "left").select("doc_id", "text", "spans").mapInArrow(
        _cut_task, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
