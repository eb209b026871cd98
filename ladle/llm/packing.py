"""Best-fit packing of tokenised documents by a grouping genetic algorithm on islands.

Documents become token ids (plus one end id) in pieces of at most ``LENGTH``; only longer documents are cut. Pieces of full
length are sequences of their own. The others are dealt at random into blocks of about ``BLOCK`` pieces; a block is a
bin-packing problem of bounded size, and blocks are solved independently. Each block has ``ISLANDS`` populations. A crossover
injects whole well-filled bins of one parent into the other, removes bins with items that would occur twice, and
places the displaced items by best fit, longest first. After every epoch each island's best solution migrates to the next.

Ids: the string forms of the special tokens are ordinary text, as the vocabulary's own notes advise. Tokens never span white
space, so the ids of a text are those of its blank-separated strings, which each worker remembers (bounded).

Defined cases: a null or empty text is the end id alone; repeated rows are packed once each; null ids are carried; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm import common

LENGTH, END_ID = 2048, 0
BLOCK, ISLANDS, EPOCHS = 4096, 2, 2
POPULATION, GENERATIONS, WELL_FILLED = 5, 6, 0.995
REMEMBERED = 1_200_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Python splits at these although the tokenizer takes them for symbols.
_ODD = re.compile("[\x1c-\x1f]")
#: Strings of these characters are unchanged by the normaliser but for case, and are split by _UNIT as the tokenizer does.
_PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
_UNIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")


class Coder:
    """Token ids of strings as little-endian unsigned 32-bit numbers; strings and their units are remembered, up to a bound.

    The units of plain strings go straight to the tokenizer's model, all others through the whole tokenizer.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(vocabulary)
        self.whole.encode_special_tokens = True
        self.model = self.whole.model
        self.byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.words: dict[str, bytes] = {}
        self.units: dict[str, bytes] = {}

    @classmethod
    def shared(cls, vocabulary: str):
        """One coder for all tasks of a worker process."""
        import tokenizers

        known = tokenizers.__dict__.setdefault("_remembered_coders", {})
        if vocabulary not in known:
            known[vocabulary] = cls(vocabulary)
        return known[vocabulary]

    def _all(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _unit(self, unit: str) -> bytes:
        if unit not in self.units:
            mapped = unit if unit.isascii() else self.byte_level.pre_tokenize_str(unit)[0][0]
            self.units[unit] = b"".join(t.id.to_bytes(4, "little") for t in self.model.tokenize(mapped))
        return self.units[unit]

    def _word(self, word: str) -> bytes:
        if not _PLAIN.fullmatch(word):
            return self._all(word)
        return b"".join(map(self._unit, _UNIT.findall(word.lower())))

    def encode(self, text: str) -> bytes:
        if _ODD.search(text):
            return self._all(text)
        words = text.split()
        try:
            return b"".join(map(self.words.__getitem__, words))
        except KeyError:
            if len(self.words) + len(self.units) > REMEMBERED:
                self.words.clear()
                self.units.clear()
            for w in set(words).difference(self.words):
                self.words[w] = self._word(w)
            return b"".join(map(self.words.__getitem__, words))


def pieces(docs: DataFrame, vocabulary: str | None = None, length: int = LENGTH) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    vocabulary = vocabulary or default_vocabulary()
    end = END_ID.to_bytes(4, "little")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder.shared(vocabulary)
        out: list[tuple] = []

        def flush():
            cols = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), *[pa.array(c, pa.int64()) for c in cols[2:]]],
                                              names=["doc_id", "piece", "start", "length", "ids_crc32"])

        for batch in batches:
            ids, column = batch.column("doc_id").to_pylist(), batch.column("text")
            for doc_id, text in zip(ids, column):
                coded = coder.encode(text.as_py() or "") + end
                for piece, at in enumerate(range(0, len(coded), 4 * length)):
                    part = coded[at:at + 4 * length]
                    out.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
                if len(out) > 5000:
                    yield flush()
        if out:
            yield flush()

    return docs.select("doc_id", "text").mapInArrow(task, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Bins:
    """A solution: item lists and fills, and open room kept sorted for best fit."""

    def __init__(self, sizes: list[int], room: int):
        self.sizes, self.room, self.items, self.fill = sizes, room, [], []

    def place(self, items: list[int]) -> Bins:
        """Best fit, in the given order."""
        shift = 32
        free = sorted((self.room - f << shift) | b for b, f in enumerate(self.fill) if f < self.room)
        for i in items:
            size = self.sizes[i]
            at = bisect_left(free, size << shift)
            if at == len(free):
                b = len(self.items)
                self.items.append([i])
                self.fill.append(size)
            else:
                b = free.pop(at) & ((1 << shift) - 1)
                self.items[b].append(i)
                self.fill[b] += size
            if self.fill[b] < self.room:
                insort(free, (self.room - self.fill[b] << shift) | b)
        return self

    def fitness(self) -> tuple[int, float]:
        """Fewer sequences first, then fuller ones."""
        return len(self.fill), -sum((f / self.room) ** 2 for f in self.fill)

    def assigned(self) -> np.ndarray:
        out = np.zeros(len(self.sizes), np.int32)
        for b, items in enumerate(self.items):
            out[items] = b
        return out

    @classmethod
    def of(cls, sizes: list[int], room: int, assigned: np.ndarray) -> Bins:
        self = cls(sizes, room)
        self.items = [[] for _ in range(int(assigned.max()) + 1)] if len(assigned) else []
        for i, b in enumerate(assigned.tolist()):
            self.items[b].append(i)
        self.fill = [sum(sizes[i] for i in items) for items in self.items]
        return self


def crossover(a: Bins, b: Bins, rng: Random) -> Bins:
    """Inject a random half of b's well-filled bins into a."""
    good = [k for k, f in enumerate(b.fill) if f >= WELL_FILLED * b.room]
    chosen = [k for k in good if rng.random() < 0.5]
    taken = {i for k in chosen for i in b.items[k]}
    child, displaced = Bins(a.sizes, a.room), []
    for k in chosen:
        child.items.append(list(b.items[k]))
        child.fill.append(b.fill[k])
    for items, fill in zip(a.items, a.fill):
        if taken.isdisjoint(items):
            child.items.append(list(items))
            child.fill.append(fill)
        else:
            displaced += [i for i in items if i not in taken]
    return child.place(sorted(displaced))  # items are numbered by falling size


def mutate(a: Bins, rng: Random) -> Bins:
    """Empty the worst-filled bins and a few others, and place their items again."""
    worst = set(sorted(range(len(a.fill)), key=a.fill.__getitem__)[:max(2, len(a.fill) // 20)])
    worst |= {rng.randrange(len(a.fill)) for _ in range(max(1, len(a.fill) // 20))} if a.fill else set()
    child, displaced = Bins(a.sizes, a.room), []
    for k, (items, fill) in enumerate(zip(a.items, a.fill)):
        if k in worst:
            displaced += items
        else:
            child.items.append(list(items))
            child.fill.append(fill)
    return child.place(sorted(displaced))


def evolve(sizes: list[int], room: int, elites: list[np.ndarray], seed: int, generations: int = GENERATIONS) -> Bins:
    """``sizes`` must fall. Start from elites that migrated here, best fit decreasing, and noisy orders; return the best."""
    rng = Random(seed)
    order = list(range(len(sizes)))
    least = -(-sum(sizes) // room)
    people = [Bins.of(sizes, room, e) for e in elites] or [Bins(sizes, room).place(order)]
    if len(people[0].fill) > least:
        while len(people) < POPULATION:
            noise = 0.02 + 0.1 * rng.random()
            people.append(Bins(sizes, room).place(sorted(order, key=lambda i: -sizes[i] * (1 - noise * rng.random()))))
        for _ in range(generations):
            people.sort(key=Bins.fitness)
            if len(people[0].fill) <= least:
                break
            people = people[:max(2, POPULATION - 2)]
            a, b = rng.sample(people, 2)
            people += [crossover(a, b, rng), crossover(people[0], b, rng), mutate(people[0], rng)]
    return min(people, key=Bins.fitness)


def _epoch(room: int, epoch: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                best = evolve(r["sizes"], room, [np.frombuffer(e, np.int32) for e in r["elites"]], (r["block"] * 31 + r["island"]) * 31 + epoch)
                n, fullness = best.fitness()
                yield pa.RecordBatch.from_arrays([pa.array([r["block"]], pa.int64()), pa.array([r["island"]], pa.int32()), pa.array([best.assigned().tobytes()], pa.binary()),
                                                  pa.array([n], pa.int32()), pa.array([fullness], pa.float64())], names=["block", "island", "best", "bins", "fullness"])
    return task


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, sequence, offset) from solved blocks."""
    for batch in batches:
        for r in batch.to_pylist():
            into, at, filled = np.frombuffer(r["best"], np.int32), [], {}
            for size, b in zip(r["sizes"], into.tolist()):
                at.append(filled.get(b, 0))
                filled[b] = at[-1] + size
            yield pa.RecordBatch.from_arrays([pa.array(r["rows"], pa.int64()), pa.array((r["block"] << 20) + into.astype(np.int64), pa.int64()), pa.array(at, pa.int64())],
                                             names=["_row", "sequence_id", "offset"])


def pack(docs: DataFrame, vocabulary: str | None = None, length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    cut = common.stage(pieces(docs, vocabulary, length).withColumn("_row", F.monotonically_increasing_id()), "pieces")
    open_ = cut.filter(F.col("length") < length)
    blocks = max(1, -(-open_.count() // block))
    dealt = open_.groupBy(F.pmod(F.xxhash64("_row"), F.lit(blocks)).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct((-F.col("length")).alias("size"), "_row"))).alias("x"))
    dealt = common.stage(dealt.select("block", F.transform("x", lambda v: (-v["size"]).cast("int")).alias("sizes"), F.transform("x", lambda v: v["_row"]).alias("rows")), "blocks")
    start = dealt.select("block", "sizes", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"))
    none = F.array().cast("array<binary>")
    state = start.withColumn("elites", none)
    schema = "block long, island int, best binary, bins int, fullness double"
    tasks = min(blocks * ISLANDS, 2000)
    for epoch in range(EPOCHS):
        solved = common.stage(state.repartition(tasks, "block", "island").mapInArrow(_epoch(length, epoch), schema), "solved")
        own = solved.select("block", "island", F.col("best").alias("own"))
        near = solved.select("block", ((F.col("island") + 1) % ISLANDS).cast("int").alias("island"), F.col("best").alias("near"))
        state = start.join(own, ["block", "island"]).join(near, ["block", "island"]).select(
            "block", "sizes", "island", F.array("own", "near").alias("elites"))
    best = solved.groupBy("block").agg(F.min_by("best", F.struct("bins", "fullness", "island")).alias("best"))
    placed = dealt.join(best, "block").mapInArrow(_unpack, "_row long, sequence_id long, offset long")
    return cut.join(placed, "_row", "left").select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("sequence_id", -1 - F.col("_row")).alias("sequence_id"),
        F.coalesce("offset", F.lit(0).cast("long")).alias("offset"))
