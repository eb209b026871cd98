"""Conversation structure repair: Wagner-Fischer alignment of turns to the alternating grammar ``(s?(ua)+)?``.

A grammar string is fixed by its length, so turns are aligned to each feasible length, nearest first. Each alignment is the
Wagner-Fischer table of the turns against that string, filled only on Ukkonen's band: the diagonals on which a path can still cost
no more than a threshold, which doubles until the path found fits it and never exceeds the incumbent, the cheapest length so far.
Lengths whose bound exceeds the incumbent are left out; of equally cheap lengths the backtraced audits are compared.

A conversation may hold a third of all rows, so it is not one alignment: blocks of ``BLOCK`` turns are aligned by themselves, from each
state the grammar can be in before them (nothing yet, after s, after u, after a) to each state behind them, and (cost, audit) of
neighbouring blocks are added, ``BLOCK`` of them at a time. Within equal states and costs no audit begins another one, so the least
audit of the whole is made of least audits. Blocks of equal content are aligned once per task.

Edits: Keep 0, Rerole to user or assistant 2, Delete 3 (the only one for blank and duplicate turns), Insert an empty user or assistant
turn 2; an undeleted truncated turn costs 1.

Defined cases: rows without a conversation id are left out; null roles and texts are one blank, null numbers come first; turns with equal
numbers are ordered by role and text; repeated rows are repeated turns; a role's initial is its first character (none for an empty one);
extra columns are ignored; an empty table gives an empty result. The audit and the repaired text of a conversation grow with its turns.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm import common
from ladle.operators.ordered import row_numbers

BLOCK, PREFIX, REMEMBERED = 64, 48, 20_000
BLANK = " \t\n\x0b\f\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: States of the grammar between two turns.
NOTHING, AFTER_S, AFTER_U, AFTER_A = range(4)
ACCEPTED = (NOTHING, AFTER_A)


def damage(rows: DataFrame) -> DataFrame:
    """Faults by crc32 of ``conv_id:turn`` modulo 20: 0 drops, 1 empties, 2 takes sentence ends, 3 repeats, 4 makes it the user's."""
    plain = rows.filter("conv_id IS NOT NULL").select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    kind = F.crc32(F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))) % 20
    text = F.when(F.col("_kind") == 1, F.lit("")).when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return plain.withColumn("_kind", kind).filter("_kind <> 0").select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")).drop("_copy")


def _target(state: int, with_s: bool, length: int) -> str:
    """The grammar string of that length that may follow ``state``."""
    body = "au" if state == AFTER_U else "ua"
    text = ("s" if with_s else "") + body * (length // 2 + 1)
    return text[:length]


def _leads_to(state: int, target: str) -> int:
    return {"s": AFTER_S, "u": AFTER_U, "a": AFTER_A}[target[-1]] if target else state


def _off(k: int) -> int:
    """The least cost of leaving a diagonal by k: deletions one way, insertions the other."""
    return DELETE * k if k > 0 else -INSERT * k


def _banded(turns: str, target: str, threshold: int) -> tuple[int, str] | None:
    """Cost and least audit of aligning ``turns`` to ``target``, if it is at most ``threshold``."""
    n, m = len(turns), len(target)
    diagonals = [k for k in range(-m, n + 1) if _off(k) + _off(n - m - k) <= threshold]
    if not diagonals:
        return None
    low, high, none = diagonals[0], diagonals[-1], 1 << 60
    # cost[i][j]: from turn i and target place j to both ends; cells off the band stay at none.
    cost = [[none] * (m + 2) for _ in range(n + 2)]
    for i in range(n, -1, -1):
        row, after = cost[i], cost[i + 1]
        code = turns[i] if i < n else ""
        extra = TRUNCATED if code.isupper() else 0
        initial = code.lower()
        for j in range(min(m, i - low), max(0, i - high) - 1, -1):
            if i == n and j == m:
                row[j] = 0
                continue
            best = after[j] + DELETE if i < n else none
            if j < m and target[j] != "s" and row[j + 1] + INSERT < best:
                best = row[j + 1] + INSERT
            if i < n and j < m and initial != "x":
                if initial == target[j]:
                    step = after[j + 1] + KEEP + extra
                else:
                    step = after[j + 1] + REROLE + extra if target[j] != "s" else none
                if step < best:
                    best = step
            row[j] = best
    if cost[0][0] > threshold:
        return None
    i, j, audit = 0, 0, []
    while i < n or j < m:
        left = cost[i][j]
        code = turns[i] if i < n else ""
        extra = TRUNCATED if code.isupper() else 0
        if i < n and cost[i + 1][j] + DELETE == left:
            audit.append("D")
            i += 1
        elif j < m and target[j] != "s" and cost[i][j + 1] + INSERT == left:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if code.lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return cost[0][0], "".join(audit)


def align(turns: str, state: int, ends: tuple[int, ...]) -> dict[int, tuple[int, str]]:
    """For each of the states ``ends``, cost and least audit of bringing ``turns`` from ``state`` to it.

    ``turns`` has a letter for each turn: s, u, a or o (any other initial), upper case if truncated, x if it must go.
    """
    n, gone = len(turns), turns.count("x")
    left, best = n - gone, {}

    def bound(m: int) -> int:
        return DELETE * max(gone, n - m) + INSERT * max(0, m - left)

    for with_s in (False, True) if state == NOTHING and "s" in turns.lower() else (False,):
        lengths = sorted(range(1 if with_s else 0, 2 * n + DELETE * n // INSERT + 4), key=lambda m: (bound(m), m))
        for m in lengths:
            target = _target(state, with_s, m)
            end = _leads_to(state, target)
            if end not in ends:
                continue
            limit = min(best[end][0] if end in best else 1 << 40, (DELETE + TRUNCATED) * n + INSERT * m)
            if bound(m) > limit:
                if all(e in best and bound(m) > best[e][0] for e in ends):
                    break
                continue
            threshold = min(max(bound(m), 4), limit)
            while (found := _banded(turns, target, threshold)) is None and threshold < limit:
                threshold = min(2 * threshold, limit)
            if found and (end not in best or found < best[end]):
                best[end] = found
    return best


_WAYS = "array<struct<start:int,stop:int,cost:bigint,audit:string>>"
_WAY = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict = {}
    for batch in batches:
        out = []
        for turns, alone, first in zip(*(batch.column(c).to_pylist() for c in ("turns", "alone", "first"))):
            key = (turns, alone, first)
            if key not in seen:
                if len(seen) >= REMEMBERED:
                    seen.clear()
                starts, ends = (NOTHING,) if first else range(4), ACCEPTED if alone else tuple(range(4))
                seen[key] = [{"start": s, "stop": e, "cost": c, "audit": a} for s in starts for e, (c, a) in sorted(align(turns, s, ends).items())]
            out.append(seen[key])
        names = [n for n in batch.schema.names if n not in ("turns", "alone", "first")]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(out, _WAY)], names=[*names, "ways"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring blocks made one: the cheapest ways over each state between them."""
    for batch in batches:
        out = []
        for blocks in batch.column("blocks").to_pylist():
            now = {(w["start"], w["stop"]): (w["cost"], w["audit"]) for w in blocks[0]["ways"]}
            for block in blocks[1:]:
                grown: dict = {}
                for (start, between), (cost, audit) in now.items():
                    for w in block["ways"]:
                        if w["start"] == between:
                            way = (cost + w["cost"], audit + w["audit"])
                            grown[start, w["stop"]] = min(way, grown.get((start, w["stop"]), way))
                now = grown
            out.append([{"start": s, "stop": e, "cost": c, "audit": a} for (s, e), (c, a) in sorted(now.items())])
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("block"), pa.array(out, _WAY)], names=["conv_id", "block", "ways"])


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each turn of the repaired conversations: its place, its turn before repair (0: none), its new role (null: kept)."""
    kinds = [("conv_id", pa.int64()), ("place", pa.int64()), ("at", pa.int64()), ("new", pa.string())]
    for batch in batches:
        rows = []
        for conv, audit in zip(batch.column("conv_id").to_pylist(), batch.column("audit").to_pylist()):
            place = at = 0
            odd = (len(audit) - audit.count("D")) % 2  # only strings with s are odd
            for edit in audit:
                at += edit != "I"
                if edit == "D":
                    continue
                place += 1
                rows.append((conv, place, 0 if edit == "I" else at, None if edit == "K" else ("user", "assistant")[(place - 1 - odd) % 2]))
                if len(rows) >= 50_000:
                    yield common._batch(rows, pa.schema(kinds))
                    rows = []
        yield common._batch(rows, pa.schema(kinds))


def assess(damaged: DataFrame) -> DataFrame:
    """The turns with ``at`` (number in the conversation, from 1), ``fault`` (blank, duplicate, truncated or none) and ``code``."""
    turns = row_numbers(damaged.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("number"), "role", "text"), "conv_id", [F.col("number"), F.col("role"), F.col("text")], "at",
                        [F.col("number"), F.substring("role", 1, PREFIX), F.substring("text", 1, PREFIX)])
    turns = common.stage(turns.withColumn("content", F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)), "turns")
    # The first turn of each content is no duplicate; every number occurs once, so this join has no hot key.
    first = turns.groupBy("conv_id", "content").agg(F.min("at").alias("at")).select("conv_id", "at", F.lit(True).alias("new"))
    end = F.rtrim(F.col("text"), F.lit(BLANK))
    fault = F.when(end == "", F.lit("blank")).when(F.col("new").isNull(), F.lit("duplicate")).when(~F.right(end, F.lit(1)).isin(".", "!", "?"), F.lit("truncated")).otherwise(F.lit(""))
    initial = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise(F.lit("o"))
    out = turns.join(first, ["conv_id", "at"], "left").withColumns({"fault": fault, "initial": initial}).drop("new", "content")
    gone = F.col("fault").isin("blank", "duplicate")
    return common.stage(out.withColumn("code", F.when(gone, F.lit("x")).when(F.col("fault") == "truncated", F.upper("initial")).otherwise(F.col("initial"))), "assessed")


def repairs(turns: DataFrame) -> DataFrame:
    """conv_id, cost, audit of the cheapest edits of each conversation of :func:`assess`."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "code"))), lambda t: t["code"]), "")
    sizes = turns.groupBy("conv_id").agg(F.max("at").alias("size"))
    blocks = turns.groupBy("conv_id", F.floor((F.col("at") - 1) / BLOCK).cast("long").alias("block")).agg(joined.alias("turns")).join(sizes, "conv_id")
    blocks = blocks.select("conv_id", "block", "turns", (F.col("size") <= BLOCK).alias("alone"), (F.col("block") == 0).alias("first"))
    ways = common.stage(blocks.mapInArrow(_aligned, f"conv_id bigint, block bigint, ways {_WAYS}"), "ways")
    done = []
    while True:
        size = ways.groupBy("conv_id").agg(F.max("block").alias("last"))
        done.append(ways.join(size.filter("last = 0").select("conv_id"), "conv_id", "left_semi"))
        more = ways.join(size.filter("last > 0").select("conv_id"), "conv_id", "left_semi")
        groups = more.groupBy("conv_id", F.floor(F.col("block") / BLOCK).cast("long").alias("to")).agg(F.array_sort(F.collect_list(F.struct("block", "ways"))).alias("blocks"))
        ways = common.stage(groups.withColumnRenamed("to", "block").mapInArrow(_added, f"conv_id bigint, block bigint, ways {_WAYS}"), "ways")
        if ways.isEmpty():
            break
    whole = done[0]
    for d in done[1:]:
        whole = whole.unionByName(d)
    fit = F.filter("ways", lambda w: w["start"].isin(NOTHING) & w["stop"].isin(*ACCEPTED))
    best = F.array_min(F.transform(fit, lambda w: F.struct(w["cost"].alias("cost"), w["audit"].alias("audit"))))
    return common.stage(whole.select("conv_id", best.alias("best")).select("conv_id", "best.cost", "best.audit"), "repairs")


def apply(turns: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, place, role, text of the repaired conversations."""
    edits = found.select("conv_id", "audit").mapInArrow(_edits, "conv_id bigint, place bigint, at bigint, new string")
    return edits.join(turns.select("conv_id", "at", "role", "text"), ["conv_id", "at"], "left").select(
        "conv_id", "place", F.coalesce("new", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def report(rows: DataFrame) -> DataFrame:
    """What was wrong with each damaged conversation of ``rows``, and its repair."""
    turns = assess(damage(rows))
    found = repairs(turns)
    before = turns.select("conv_id", (F.col("at") + 1).alias("at"), F.col("initial").alias("was"))
    pair = F.concat("was", "initial")
    counts = turns.join(before, ["conv_id", "at"], "left").groupBy("conv_id").agg(
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")],
        F.count_if(F.col("was").isNotNull() & ~pair.isin("su", "ua", "au")).alias("illegal"))
    numbers = turns.filter("number IS NOT NULL").select("conv_id", "number").distinct().groupBy("conv_id").agg(
        (F.max("number") - F.min("number") + 1 - F.count("*")).alias("gaps"))
    fixed = apply(turns, found).withColumn("line", F.concat("role", F.lit(":"), "text"))
    digests = common.ordered_digest(fixed, ["conv_id"], ["place"], "line", "\n")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return rows.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id")).distinct().join(counts, "conv_id", "left").join(numbers, "conv_id", "left").join(
        found, "conv_id", "left").join(digests, "conv_id", "left").select(
        "conv_id", *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
