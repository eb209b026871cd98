"""Operators on conversations and the toxicity classifier against brute force, with the edge cases their docstrings define."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ladle.llm import common, queries, repair, toxicity, trie
from ladle.llm.common import read

SCHEMA = "conv_id long, turn long, role string, text string"


def same(got, want):
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def talks(seed, n=60, words=2, longest=6):
    """Many shared beginnings, ties, nulls, repeated rows, a long and a hot conversation, and ids with gaps."""
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        c = c * (3 if c > n // 2 else 1) - 7
        for t in range(rnd.randint(0, longest)):
            rows.append((c, t, rnd.choice(["user", "assistant", "user", None, ""]) if rnd.random() < 0.2 else ["user", "assistant"][t % 2],
                         None if rnd.random() < 0.05 else "né " * rnd.randint(0, words)))
    rows += [(c, t, "user", "hot") for c in range(500, 560) for t in range(3)]
    rows += [(700, t, ["user", "assistant"][t % 2], f"long {t % 7}") for t in range(45)]
    rows += [(3, None, "user", "early"), (3, None, "system", "early"), (4, 1, "user", "tie"), (4, 1, "user", "tie"), (4, 1, "assistant", None), (None, 0, "user", "lost")]
    rnd.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS pos", "2 AS depth", "'x' AS name", "3 AS value", "4 AS _part", "5 AS number").repartition(3)


def trie_by_hand(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    for log in own.values():
        log.sort(key=lambda r: (r[0], r[1], r[2].encode(), r[3].encode()))
    built = {}
    for c, log in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(abs(c) % 5 * (1 if c >= 0 else -1))
        built[c] = [r[2:] for r in own.get(base, [])[:h]] + [r[2:] for r in log[h:]]
    members = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, convs in members.items():
        below = [q for q in members if q[:len(p)] == p]
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(p))
        yield (min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), children[p], sum(not children[q] for q in below),
               sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q), hashlib.sha256(ends.encode()).hexdigest())


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_brute_force(spark, seed):
    rows = talks(seed)
    got = trie.nodes(*trie.lend(trie.turns(frame(spark, rows))))
    same(got.collect(), trie_by_hand(rows))


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    empty = frame(spark, [(1, 0, "a", "b")]).filter("false")
    assert trie.nodes(*trie.lend(trie.turns(empty))).count() == 0
    rows = [(41, 0, "user", "x"), (42, 0, "user", "x")]  # 40 is absent; what these begin with is replaced by nothing
    assert all(zlib.crc32(str(c).encode()) % 9 for c in (41, 42))
    same(trie.nodes(*trie.lend(trie.turns(frame(spark, rows)))).collect(), trie_by_hand(rows))


def test_ordered_digest_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(common, "PIECE_BYTES", 64)
    rows = [(k, i, "é" * (i % 5)) for k in (None, 1, 2, 3) for i in range(200 if k == 2 else 7)]
    df = spark.createDataFrame(rows, "k int, i int, v string").repartition(7)
    got = {r.k: r.sha256 for r in common.ordered_digest(df, ["k"], ["i"], "v", "|").collect()}
    want = {k: hashlib.sha256("|".join(v for x, _, v in rows if x == k).encode()).hexdigest() for k in (None, 1, 2, 3)}
    assert got == want


def repair_by_hand(rows):
    """Cheapest audits over the states of the grammar, turn by turn."""
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is None:
            continue
        convs[c]
        r, x = " " if r is None else r, " " if x is None else x
        kind = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        if kind:
            x = "" if kind == 1 else "".join(y for y in x if y not in ".!?") if kind == 2 else x
            convs[c] += [(t, "user" if kind == 4 else r, x)] * (2 if kind == 3 else 1)
    for c, log in convs.items():
        log.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, r, x in log:
            end = x.rstrip(" \t\n\x0b\f\r")
            faults.append("blank" if not end else "duplicate" if (r, x) in seen else "truncated" if end[-1] not in ".!?" else "")
            seen.add((r, x))
            if faults[-1]:
                counts[faults[-1]] += 1
        moves = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
        names = {"u": "user", "a": "assistant"}

        def inserted(ways):
            for _ in range(2):
                for st, (cost, audit, out) in list(ways.items()):
                    for (a, x), b in moves.items():
                        if a == st and x != "s":
                            way = (cost + 2, audit + "I", (*out, names[x] + ":"))
                            ways[b] = min(way, ways.get(b, way))
            return ways

        ways = {0: (0, "", ())}
        for (_, r, x), fault in zip(log, faults):
            after = {}
            for st, (cost, audit, out) in inserted(ways).items():
                steps = [(st, cost + 3, "D", out)]
                if fault not in ("blank", "duplicate"):
                    late = fault == "truncated"
                    for (a, y), b in moves.items():
                        if a == st and r[:1] == y:
                            steps.append((b, cost + late, "K", (*out, f"{r}:{x}")))
                        elif a == st and y != "s":
                            steps.append((b, cost + 2 + late, "R", (*out, f"{names[y]}:{x}")))
                for b, k, letter, text in steps:
                    way = (k, audit + letter, text)
                    after[b] = min(way, after.get(b, way))
            ways = after
        cost, audit, out = min(w for st, w in inserted(ways).items() if st in (0, 3))
        numbers = {t for t, _, _ in log if t is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(log, log[1:]))
        yield (c, max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, *counts.values(), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def spoken(seed, n=60, longest=9):
    rnd = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rnd.randint(1, longest) if c else 70):
            role = rnd.choice(["user", "assistant", "system", "tool", "", None, "sage"]) if rnd.random() < 0.35 else ["user", "assistant"][t % 2]
            rows.append((c, None if rnd.random() < 0.05 else t + (t > 4), role, rnd.choice(["Yes.", "No", "What? ", " \n", "né!", f"turn {t}.", f"part {t}", None])))
    return rows + [(None, 0, "user", "lost")]


@pytest.mark.parametrize("block", [64, 3])
def test_repair_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rows = spoken(block)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS at", "'x' AS fault", "3 AS code", "4 AS _kind").repartition(3)
    same(repair.report(df).collect(), repair_by_hand(rows))


def test_repair_of_nothing(spark):
    assert repair.report(frame(spark, [(1, 0, "a", "b")]).filter("false")).count() == 0
    gone = [(c, t, "user", "x") for c in range(40) for t in range(2) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    got = repair.report(frame(spark, gone)).collect()
    assert len(got) == len({r[0] for r in gone}) and {(r.audit, r.cost, r.repaired_sha256) for r in got} == {("", 0, hashlib.sha256(b"").hexdigest())}


def test_toxicity_on_held_out_rows_and_odd_inputs(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op13_toxicity(spark, sf)
    assert got.count() == read(spark, sf, "documents").count()
    assert got.filter("(score >= 0.5) <> (predicted = 1) OR score < 0 OR score > 1").isEmpty()
    held = got.filter("held_out").join(read(spark, sf, "labels"), "doc_id").select("toxic", "predicted").collect()
    caught = [r.predicted for r in held if r.toxic == 1]
    clean = [r.predicted for r in held if r.toxic == 0]
    assert sum(caught) / len(caught) > 0.75 and sum(clean) / len(clean) < 0.01
    wrong = {r.doc_id for r in got.select("doc_id", "held_out").collect() if r.held_out != (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)}
    assert not wrong


def test_toxicity_bounds_and_empty_cases(spark, monkeypatch):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a b"), (3, "awful " * 3000), (4, "fine day"), (4, "fine day")], "doc_id long, text string")
    docs = docs.selectExpr("*", "7 AS label", "8 AS score", "9 AS turn_order", "'x' AS coordinates")
    labels = spark.createDataFrame([(3, 1, 1), (4, 0, 0), (4, 0, 0), (99, 1, 1), (None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model)
    assert got.columns == ["doc_id", "text", "label", "turn_order", "coordinates", "score"]
    by_text = {r.text: r.score for r in got.collect()}
    assert by_text[None] == by_text[""] and len(by_text) == 5
    nothing = toxicity.score(docs, toxicity.fit(docs, labels.filter("false")))
    assert {r.score for r in nothing.collect()} == {0.5}
    assert toxicity.score(docs.filter("false"), model).count() == 0
    many = spark.range(500).selectExpr("3L AS doc_id", "concat('row ', id) AS text")
    seen = []
    inner = common.stage
    monkeypatch.setattr(common, "stage", lambda df, name: seen.append(out := inner(df, name)) or out)
    toxicity.fit(many, labels, fit_rows=20)
    assert seen[-1].count() == 20
