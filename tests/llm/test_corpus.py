"""Corpus operators against brute force, exact round trips and held-out accuracy, with the edge cases their docstrings define."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ladle.llm import ann, chat, decontam, licenses, neardup, packing, pii, quality, suffixes, warc
from ladle.llm.common import read

BLANK = re.compile("[\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def docs(spark):
    return read(spark, "/root/testdata/sf0.001", "documents")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and blank texts, short texts, a long text, ties, repeated rows, and extra columns with clashing names."""
    passage = " ".join(f"w{i * 7919 % 1000}" for i in range(120))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "one two"), (5, "one two"), (6, passage), (7, passage + " tail"), (8, "x " + passage.upper()), (None, passage),
            (None, None), (9, "é" * 300), (10, "a" * 5000), (11, "b c " * 4000), (12, "7" * 30), (13, passage[:300] + " cut " + passage[300:])]
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS key", "2 AS value", "'x' AS hash", "3 AS label", "4 AS _row", "5 AS score")


def texts(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def same(got, want):
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def repeats(rows):
    seen = Counter()
    data = [(d, (t or "").encode()) for d, t in rows]
    for _, b in data:
        seen.update(b[i:i + 200] for i in range(len(b) - 199))
    for d, b in data:
        gone = np.zeros(len(b) + 1, int)
        for i in range(len(b) - 199):
            if seen[b[i:i + 200]] > 1:
                gone[i] += 1
                gone[i + 200] -= 1
        gone = np.cumsum(gone)[:len(b)] > 0
        runs = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        yield d, len(b), int(gone.sum()), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()


@pytest.mark.parametrize("units", [20_000, 20])
def test_suffixes_equal_brute_force(odd, docs, monkeypatch, units):
    monkeypatch.setattr(suffixes, "BUCKET_UNITS", units)
    frame = odd if units > 20 else docs
    same(suffixes.remove_repeats(frame).collect(), repeats(texts(frame)))
    assert suffixes.remove_repeats(frame.limit(0)).count() == 0


def test_suffix_classes_cross_splitters(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "BUCKET_UNITS", 5)
    passage = "".join(chr(97 + (i * i * 31 + i * 7) % 26) for i in range(600))
    frame = spark.createDataFrame([(i, f"{i * 977 % 1000}" * (i % 9) + passage[50:450] + f"{i * 77}" * (i % 7)) for i in range(50)], "doc_id long, text string")
    same(suffixes.remove_repeats(frame).collect(), repeats(texts(frame)))


def test_a_hot_passage_is_dealt_over_buckets(spark, monkeypatch, tmp_path):
    """400 texts go on with one passage; their own texts before it make as many units with one suffix."""
    inner = suffixes._bucket_task

    def counting(*args):
        task = inner(*args)

        def counted(table):
            (tmp_path / str(table.column("bucket")[0].as_py())).write_text(f"{table.num_rows} {(found := task(table)).column('window').drop_null().length()}")
            return found
        return counted
    monkeypatch.setattr(suffixes, "BUCKET_UNITS", 40)
    monkeypatch.setattr(suffixes, "_bucket_task", counting)
    rng = np.random.default_rng(5)
    passage = bytes(rng.integers(97, 123, 420).astype(np.uint8)).decode()
    rows = [(i, bytes(rng.integers(97, 123, 170).astype(np.uint8)).decode() + (f"same{i % 20:02}" * 4 if i % 4 == 0 else "") + passage) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    same(suffixes.remove_repeats(frame).collect(), repeats(rows))
    units, digests = zip(*(map(int, f.read_text().split()) for f in tmp_path.iterdir()))
    assert sum(units) >= 400 and max(units) <= 4 * 40 and sum(digests) <= 30 * sum(units)


def test_multikey_sort_orders_and_measures():
    rng = np.random.default_rng(0)
    rows = [bytes(rng.integers(97, 99, 16).astype(np.uint8)) for _ in range(300)]
    order, shared = suffixes.multikey_sort(suffixes._words(rows, 16))
    placed = [rows[i] for i in order]
    assert placed == sorted(rows)
    for a, b, n in zip(placed, placed[1:], shared[1:]):
        assert n == next((i for i in range(16) if a[i] != b[i]), 16)


def test_ann_recall_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((1500, 24)).astype(np.float32)
    x[100:160] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    bad = [(9000, None), (9001, [0.0] * 24), (9002, [float("nan")] * 24), (9020, [1.0, None] * 12), (9040, [float("inf")] * 24), (None, x[0].tolist()), (100, x[100].tolist()), (9060, [])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").withColumn("vector", F.lit(1))
    got = defaultdict(list)
    for r in ann.search(df, df.filter("vec_id % 20 = 0"), k=20).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    score = x.astype(float) @ x.astype(float).T
    hits = 0
    for q in range(0, 1500, 20):
        want = sorted((i for i in range(1500) if i != q), key=lambda i: (-round(score[q, i], 9), i))[:20]
        assert len(got[q]) == 20 and all(abs(s - score[q, v]) < 1e-9 for v, s in got[q])
        hits += len(set(want) & {v for v, _ in got[q]})
    assert set(got) == set(range(0, 1500, 20)) and hits >= 0.9 * 20 * len(got)
    assert [v for v, _ in got[100]][:19] == list(range(101, 120))
    few = df.filter("vec_id IN (0, 1, 2)")
    assert sorted(r.vec_id for r in ann.search(few, few.filter("vec_id = 0")).collect()) == [1, 2]
    assert ann.search(df.limit(0), df.limit(0)).count() == 0


def test_ann_few_large_graphs_in_several_tasks(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.standard_normal((5000, 4)))], "vec_id long, embedding array<float>")
    # A query visits every graph: a table five times as large must not have five times as many of them.
    assert ann.index(df, 20).count() == 1
    few = df.filter("vec_id < 800")
    graphs = ann.index(few, 20, shard=50)
    assert graphs.count() == 16 and len(graphs.inputFiles()) > 4
    split = ann.search(few, few.filter("vec_id % 20 = 0"), k=5, shard=50)
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, ann.search(few, few.filter("vec_id % 20 = 0"), k=5).collect()))


def base_spans(text):
    out = []
    for k, p in enumerate([r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            luhn = sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d))) % 10 == 0
            if (True, all(int(x) <= 255 for x in m[0].split(".")) if k == 1 else False, 12 <= len(d) <= 19 and luhn, 9 <= len(d) <= 15)[k]:
                out.append((m.start(), k, m.end()))
    return ",".join(f"{('email', 'ip', 'card', 'phone')[k]}:{s}:{e}" for s, k, e in sorted(out))


def test_pii_base_equals_brute_force(spark, docs, odd):
    tricky = spark.createDataFrame([(1, "a@b.co @c.de x.@y.z. a@b 1.2.3.4.5.6.7.8 256.1.1.1 000255.1.1.1 é 4111 1111-1111 1111 4111--1111 +1 (222) 333-4444. +12 3"),
                                    (2, "1 2 " * 4000 + "a@" + "b." * 4000 + "c"), (3, "1." * 6000 + "+" + "9" * 40)], "doc_id long, text string")
    for frame in (docs, odd, tricky):
        found = pii.with_candidates(frame)
        got = pii.report(found, pii.fit(found)).select("doc_id", "base_sha256").collect()
        same(got, [(d, hashlib.sha256(base_spans(t).encode()).hexdigest()) for d, t in texts(frame)])
    empty = pii.with_candidates(docs.limit(0))
    assert pii.report(empty, pii.fit(empty)).count() == 0


def test_pii_redaction_keeps_everything_else(spark):
    frame = spark.createDataFrame([(1, 'mail é a@b.com now, token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" end', 70), (2, "clean", 5), (3, None, None)], "doc_id long, text string, n_chars long")
    frame = frame.unionByName(frame.selectExpr("doc_id + 10 AS doc_id", "text", "n_chars"))
    found = pii.with_candidates(frame)
    got = {r.doc_id: (r.text, r.n_chars) for r in pii.redact(found, pii.fit(found)).collect()}
    assert got[1][0].startswith("mail é [EMAIL] now, token = ") and "24be" not in got[1][0] and got[1][1] == len(got[1][0])
    assert got[2] == ("clean", 5) and got[3][0] is None


def redacted(text, spans):
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_pii_redacts_exactly_the_reported_spans_and_keeps_clashing_columns(spark):
    """Overlaps of kinds, block edges, characters beyond the first plane; columns of any name stay."""
    texts_ = ["\U0001f600 a@1.2.3.4 +1.2.3.4.5.6.7.8.9 " + "é" * k + " x@y.de 4111 1111 1111 1111@b.c 078-05-1120 call 212-555-0123." for k in (0, 1, 440, 480, 505, 511, 512, 2000)]
    frame = spark.createDataFrame(list(enumerate(texts_)), "doc_id long, text string").selectExpr("*", "7 AS _s", "8 AS _new", "9 AS _found", "'mine' AS _cands")
    found = pii.with_candidates(frame, "_spans")
    accepted = pii.fit(found, name="_spans")
    spans = {r.doc_id: [(k, int(s), int(e)) for k, s, e in (x.split(":") for x in r.spans.split(","))] for r in pii.report(found, accepted, "_spans").collect()}
    rows = pii.redact(found, accepted, "_spans").collect()
    assert {r.doc_id: r.text for r in rows} == {i: redacted(t, spans[i]) for i, t in enumerate(texts_)}
    assert all((r._s, r._new, r._found, r._cands) == (7, 8, 9, "mine") for r in rows)


def test_pii_other_spans_never_touch_base_spans(spark, docs):
    found = pii.with_candidates(docs)
    kinds = list(pii.KINDS)
    every = pii.fit(found) + [f"{r.k}:{r.v}" for r in found.select(F.explode("_cands").alias("c")).select(F.col("c.kind").alias("k"), F.col("c.votes").alias("v")).distinct().collect()]
    rows = pii.report(found, every).select("doc_id", "spans").collect()
    cands = defaultdict(set)
    for r in found.select("doc_id", F.explode("_cands").alias("c")).select("doc_id", "c.*").collect():
        cands[r.doc_id].add((r.start, kinds.index(r.kind), r.end, r.base))
    for doc_id, spans in rows:
        base = [c for c in cands[doc_id] if c[3]]
        more = [c for c in cands[doc_id] if c[1] > 3 and not any(b[0] < c[2] and c[0] < b[2] for b in base)]
        assert spans == ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e, _ in sorted(base + more))


def test_pii_lists_vote_on_the_decided_kinds(spark):
    cases = [("secret", "ghp_0a1b2c3d4e5f6g7h8i9j0k", "1"), ("secret", "d41d8cd98f00b204e9800998ecf8427e", "0"), ("secret", "q9w8e7r6t5y4u3i2o1p0z", "-"),
             ("local_phone", "(212) 736-5000", "1"), ("local_phone", "212-555-0123", "0"), ("local_phone", "911-736-5000", "0"), ("local_phone", "385-736-5000", "-"),
             ("national_id", "078-05-1120", "0"), ("national_id", "531-22-4481", "-"), ("email", "a@b.com", "1")]
    s = F.struct(F.col("kind").alias("kind"), F.col("t").alias("text"), F.lit("").alias("left"), F.lit("").alias("right"))
    got = spark.createDataFrame(cases, "kind string, t string, want string").select("t", "want", F.substring(pii.votes(s), 2, 1).alias("got")).collect()
    assert [(r.t, r.got) for r in got] == [(r.t, r.want) for r in got]


def test_pii_many_matches_in_one_text(spark):
    n = 16_000
    text = " ".join(f"u{i}@b.de" for i in range(n))
    found = pii.with_candidates(spark.createDataFrame([(1, text)], "doc_id long, text string"))
    assert pii.report(found, []).first().n_email == n
    assert pii.redact(found, []).first().text == " ".join(["[EMAIL]"] * n)


def test_em_follows_the_reliable_labelers():
    """Three labelers agree; the fourth votes at random and must not decide."""
    table = [("secret", a * 3 + b + "-", 25) for a in "10" for b in "10"]
    post = pii.expectation_maximisation(sorted(table))
    assert [p > 0.5 for p in post] == [False, False, True, True]
    assert [p > 0.5 for p in pii.classify(sorted(table), post)] == [False, False, True, True]


def linked(rows, percent):
    sets = defaultdict(list)
    for d, t in rows:
        if d is not None:
            sets[d].append(neardup.shingle_strings((t or "").encode()))
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if any(s and t and 100 * len(s & t) >= percent * len(s | t) for s in sets[a] for t in sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [(d, len(neardup.shingle_strings((t or "").encode())), find(d) if d is not None else None, d is None or find(d) == d) for d, t in rows]


@pytest.mark.parametrize("percent", [80, 85])
def test_neardup_equals_brute_force(docs, odd, percent):
    for frame in (docs, odd):
        same(neardup.classes(frame, percent).collect(), linked(texts(frame), percent))


def test_neardup_links_across_a_hot_passage(spark):
    """Many texts share most of their words without being linked; a few pairs among them are."""
    hot = " ".join(f"h{i}" for i in range(60))
    rows = [(i, hot + " " + " ".join(f"d{i}x{j}" for j in range(40))) for i in range(150)] + [(1000 + i, hot + " " + " ".join(f"d{i}x{j}" for j in range(38))) for i in range(0, 150, 10)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    same(neardup.classes(frame, 85).collect(), linked(rows, 85))
    kept = {r.doc_id for r in neardup.keep_one(frame, 85).collect()}
    assert kept == set(range(150)) and neardup.classes(frame.limit(0)).count() == 0


def test_keep_one_keeps_different_texts_of_one_id(spark):
    one, two, three = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, one), (1, two), (1, two), (2, three), (3, two + " tail"), (4, one), (None, one), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS node", "2 AS first", "'x' AS row", "4 AS id", "5 AS key")
    got = neardup.keep_one(frame, 80)
    assert got.columns == frame.columns
    kept = texts(got)
    # Of each of the three texts one copy stays, whatever its id; rows without an id stay.
    assert len([r for r in kept if r[0] is None]) == 2 and sorted(t.split()[0] for d, t in kept if d is not None) == ["a0", "b0", "c0"]
    lone = spark.createDataFrame([(1, one), (1, two), (2, three)], "doc_id long, text string")
    same(texts(neardup.keep_one(lone, 80)), [(1, one), (1, two), (2, three)])


def test_quality_fit_bound_holds_after_the_join(spark, monkeypatch):
    many = spark.range(600).selectExpr("3L AS doc_id", "concat('row ', id) AS text", "1 AS _quality", "2 AS key")
    labels = spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int")
    rows = []
    inner = np.stack
    monkeypatch.setattr(quality.np, "stack", lambda x, **k: rows.append(len(x)) or inner(x, **k))
    model = quality.fit(many, labels, fit_rows=6)
    assert rows[0] == 6 and quality.keep(many, model).columns == many.columns


def test_short_items_inside_longer_documents(spark):
    items = spark.createDataFrame([(1, "Zulu"), (2, "two words"), (3, "a b c d"), (4, "a b c d e"), (5, None), (6, "zulu"), (None, "two words")], "item_id long, text string")
    rows = [(1, "so zulu it is"), (2, "zulus two  WORDS here"), (3, "x a b\tc d y"), (4, "a b c d e f"), (5, "zulu"), (6, "two"), (7, None), (None, "one two words three four five")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS _bad", "2 AS run", "3 AS n")
    want = [(1, 1), (1, 6), (2, 2), (2, None), (3, 3), (4, 3), (4, 4), (5, 1), (5, 6), (None, 2), (None, None)]
    got = decontam.matches(frame, items)
    same([(r.doc_id, r.item_id) for r in got.collect()], want)
    assert {(r.n_item, r.n_shared, r.containment) for r in got.collect()} == {(1, 1, 1.0)}
    assert sorted(r.doc_id for r in decontam.clean(frame, items).collect()) == [6, 7]


def test_packing_round_trip(docs, odd):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(packing.default_vocabulary())
    whole.encode_special_tokens = True
    for frame in (docs, odd):
        want, got = [], packing.pack(frame).collect()
        for d, t in texts(frame):
            ids = whole.encode(t or "", add_special_tokens=False).ids + [0]
            want += [(d, p, s, len(ids[s:s + 2048]), zlib.crc32(np.array(ids[s:s + 2048], "<u4").tobytes())) for p, s in enumerate(range(0, len(ids), 2048))]
        same([tuple(r)[:5] for r in got], want)
        bins = defaultdict(list)
        for r in got:
            bins[r.sequence_id].append((r.offset, r.length))
        for parts in bins.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= 2048
        assert len(bins) <= -(-sum(r.length for r in got) // 2048) * 1.02 + 1
    assert packing.pack(docs.limit(0)).count() == 0


def test_coder_equals_the_tokenizer_on_odd_strings():
    coder = packing.Coder(packing.default_vocabulary())
    for text in ["It's <|endoftext|> don't'll", "ÀÉß ñ÷× ¼ ﬁ İI ΑΣ", "é ́x", "a\x1cb\x85c\xa0d e", "日本語テキスト 123", "###''s --- 12ab34", "퟿\U0001f600"]:
        want = coder.whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == want, text


def test_crossover_keeps_every_item_once():
    from random import Random
    rng = Random(5)
    sizes = sorted((rng.randrange(1, 2048) for _ in range(400)), reverse=True)
    a = packing.Bins(sizes, 2048).place(list(range(400)))
    b = packing.Bins(sizes, 2048).place(sorted(range(400), key=lambda i: -sizes[i] * rng.random()))
    for child in (packing.crossover(a, b, rng), packing.mutate(a, rng), packing.evolve(sizes, 2048, [b.assigned()], 1)):
        assert sorted(i for items in child.items for i in items) == list(range(400)) and max(child.fill) <= 2048
        assert child.fill == [sum(sizes[i] for i in items) for items in child.items]


@pytest.mark.parametrize("range_bytes", ["128m", "150b"])
def test_warc_rejects_magic_inside_payloads(spark, range_bytes):
    """Also where records, headers and magic lines lie across the byte ranges that tasks read."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", range_bytes)
    try:
        check_warc(spark)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def check_warc(spark):
    evil = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99999>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" + "y" * 200
    rows = [(1, "u v\r\nz", evil), (2, None, evil), (2, None, evil), (3, "a", None), (None, "n", "q" * 200), (None, "n", "q" * 200), (4, "b", "short"), (5, "b", "short"),
            (6, "c", "WARC/1.1\r\n" * 30), (7, "d", "é" * 90)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS size", "2 AS digest", "3 AS first")
    first, want, seen = {}, [], set()
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 100:
            d = hashlib.sha256(b).hexdigest()
            first[d] = min(first.get(d, 10**9), 10**9 if i is None else i)
    for i, _, h in rows:
        b = (h or "").encode()
        d = hashlib.sha256(b).hexdigest()
        again = d in first and (d in seen or first[d] != (10**9 if i is None else i))
        if not again:
            seen.add(d)
        want.append((i, len(b), d, "revisit" if again else "response", first[d] if again and first[d] < 10**9 else None))
    same(warc.round_trip(pages).collect(), want)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_licenses_base_equals_brute_force(docs, odd, spark):
    extra = spark.createDataFrame([(1, "Under the MIT-License, under The mit license; CC BY-NC 4.0 é"), (2, "Licensed under the GNU General Public License, version 3."), (3, "SPDX-License-Identifier: BSD-3-Clause")],
                                  "doc_id long, text string")
    for frame in (docs, odd, extra):
        got = {(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.scan(frame).collect()}
        want = set()
        for d, t in texts(frame):
            w = licenses.WORD.findall((t or "").translate({i: i + 32 for i in range(65, 91)}))
            hits = [(i, label) for p, label in licenses.BASE.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
            want.add((d, len(w), len(hits), min((i for i, _ in hits), default=None), max((i for i, _ in hits), default=None), ",".join(sorted({x for _, x in hits}))))
        assert got == want
    labels = {r.doc_id: r.labels for r in licenses.scan(extra).collect()}
    assert labels[1] == "cc-by-nc,mit" and labels[2] == "gpl-3" and labels[3] == "bsd-3"
    assert licenses.scan(docs.limit(0)).count() == 0 and len(licenses.rules()) > 200


def written(tree):
    """Every string that a parsed name can stand for; optional parts are left out or taken once."""
    out = [""]
    for op, arg in tree:
        op = str(op)
        if op == "LITERAL":
            parts = [chr(arg)]
        elif op == "IN":
            parts = [chr(c) for _, c in arg]
        elif op == "BRANCH":
            parts = [x for branch in arg[1] for x in written(branch)]
        elif op == "SUBPATTERN":
            parts = written(arg[3])
        elif op == "MAX_REPEAT":
            parts = ["", *written(arg[2])]
        else:
            assert op == "ASSERT_NOT", op
            parts = [""]
        out = [a + b for a in out for b in parts]
    return out


def test_license_gates_lose_no_detection(spark):
    ordered = [(*rule[:3], re.compile(""), rule[4]) for rule in licenses.rules()]
    frames = ["Released and sold under\n{}.", "SPDX-License-Identifier: {}", "licensed as {}", "a {} licence", "license is of the {}", "Licence is " + "the " * 60 + "{} or not", "under\t{}"]
    rows = [(i, frame.format(name)) for i, (frame, name) in enumerate(
        (frame, name) for _, name in licenses.LICENSES.values() for name in written(re._parser.parse(name)) for frame in frames)]
    rows += [(-1, "licensed under the expat license"), (-2, "under the x11 license"), (-3, "released under the freebsd license"), (-4, "licensed under the gfdl 1 3"), (-5, "released under\nGPL version 2")]
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), {"no such words": "none"}).collect()}
    for i, text in rows:
        found = licenses.detect(" ".join(licenses.WORD.findall(text.lower())), ordered)
        assert got[i] == (",".join(sorted({label for _, _, label, _ in found})), max((w for *_, w in found), default=0.0)), text
    assert [got[-i][0] for i in range(1, 6)] == ["mit", "mit", "bsd-2", "fdl-1", "gpl-2"]
    own = licenses.scan(spark.createDataFrame([(1, "The Foo-Bar é terms"), (2, "foo é bar")], "doc_id long, text string"), {"foo bar é": "own"})
    assert {r.doc_id: r.base_labels for r in own.collect()} == {1: "own", 2: ""}


def test_lists_of_licenses_keep_every_label(spark):
    want = {"MIT License, Apache License 2.0": "apache-2,mit", "MIT License, MPL 2.0": "mit,mpl-2", "ISC License; zlib License; GPL v3": "gpl-3,isc,zlib",
            "Licensed under CC BY-NC-SA 4.0": "cc-by-nc-sa", "License: CC BY-NC-SA license": "cc-by-nc-sa", "licensed under the GNU Lesser General Public License version 2.1": "lgpl-2"}
    got = licenses.scan(spark.createDataFrame(list(enumerate(want)), "doc_id long, text string"), {"no such words": "none"}).collect()
    assert {r.doc_id: r.labels for r in got} == dict(enumerate(want.values()))


def test_quality_on_held_out_rows(spark, odd):
    docs, labels = (read(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    rows = quality.score(docs.select("doc_id", "text"), model).join(labels, "doc_id").filter(quality.fold(F.col("doc_id")) == 0).select("score", "quality").collect()
    assert sum((r.score >= 0.3) == (r.quality == 1) for r in rows) / len(rows) > 0.98
    scored = quality.score(odd, model, "_s")
    assert scored.columns == [*odd.columns, "_s"] and scored.count() == odd.count() and scored.filter("_s IS NULL OR _s < 0 OR _s > 1").count() == 0
    assert quality.fit(docs, labels.limit(0))["bias"] == 0.0 and quality.score(odd.limit(0), model, "_s").count() == 0


def test_linear_time_scoring_equals_the_sum_over_pairs():
    rng = np.random.default_rng(2)
    n = quality.BUCKETS + len(quality.STATS)
    model = {"bias": 0.1, "w": rng.standard_normal(n).astype(np.float32) * 0.1, "v": rng.standard_normal((n, 3)).astype(np.float32) * 0.1,
             "mean": np.zeros(len(quality.STATS)), "scale": np.ones(len(quality.STATS))}
    stats, bucket, value = rng.standard_normal((1, len(quality.STATS))), np.array([3, 17, 99]), np.array([0.5, 1.0, 0.2])
    x = np.zeros(n)
    x[bucket], x[quality.BUCKETS:] = value, stats[0]
    on = np.flatnonzero(x)
    pairs = sum(float(model["v"][i] @ model["v"][j]) * x[i] * x[j] for a, i in enumerate(on) for j in on[a + 1:])
    want = 1 / (1 + np.exp(-(0.1 + x @ model["w"] + pairs)))
    assert abs(quality._score(model, stats, np.zeros(3, int), bucket, value)[0] - want) < 1e-5


def test_chat_round_trip(spark):
    rows = [(1, 0, "user", "</s>[INST] & &amp; &lb; <turn x>"), (1, 1, "assistant", "a\\[b]\n<s>"), (2, 0, "assistant", "x"), (2, 0, "assistant", "x"), (3, None, None, None), (4, 0, "a>b<[", ""), (None, 1, "system", "s"),
            (None, 2, "user", None), (5, 0, "user", "u"), (5, 1, "user", "v")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS turns", "2 AS body", "3 AS segments")
    made = chat.format_conversations(frame)
    got = {r.conv_id: r for r in chat.digest(made).collect()}
    per = defaultdict(list)
    for c, t, r, x in rows:
        per[c].append((-1 if t is None else t, r or "", x or ""))
    for c, turns in per.items():
        turns.sort()
        said, learn = "".join(f"{r}\n{x}\n" for _, r, x in turns), "".join(x for _, r, x in turns if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars) == (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learn))
        assert got[c].loss_sha256 == hashlib.sha256(learn.encode()).hexdigest()
    assert {c for c, r in got.items() if r.valid} == {1, None}
    assert chat.digest(chat.format_conversations(frame.limit(0))).count() == 0


def test_decontamination_equals_brute_force(spark, docs, odd):
    items = read(spark, "/root/testdata/sf0.001", "benchmark")
    more = spark.createDataFrame([(900, " ".join(f"w{i * 7919 % 1000}" for i in range(10, 90))), (900, "one two"), (901, None), (902, ""), (None, "b c b c b c b c")], "item_id long, text string").selectExpr("*", "1 AS hash")

    def shingled(t):
        w = [x for x in BLANK.split((t or "").lower()) if x]
        return {" ".join(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {" ".join(w)} - {""}

    for frame, bench in ((docs, items), (odd, more)):
        want = {(d, i) for d, t in texts(frame) for i, b in ((r.item_id, shingled(r.text)) for r in bench.collect()) if b and len(b & shingled(t)) * 1000 >= 800 * len(b)}
        assert {(r.doc_id, r.item_id) for r in decontam.matches(frame, bench).collect()} == want and want
        bad = {d for d, _ in want}
        assert sorted((r.doc_id for r in decontam.clean(frame, bench).collect()), key=str) == sorted((d for d, _ in texts(frame) if d not in bad), key=str)
    assert decontam.matches(docs.limit(0), items).count() == 0 and decontam.matches(docs, items.limit(0)).count() == 0


def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline
    sf = "/root/testdata/sf0.001"
    docs = read(spark, sf, "documents")
    columns, bench = docs.columns, read(spark, sf, "benchmark")
    for name, function in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, function(spark, docs, sf)
        assert sorted(docs.columns) == sorted(columns), name
        docs = docs.select(columns)
        docs.write.mode("overwrite").parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/stage-{name}")
        docs = spark.read.parquet(path)
        if name == "neardup":
            same(docs.select("doc_id").collect(), [(d,) for d, _, c, k in linked(texts(before), 80) if k])
        if name == "decontam":
            assert decontam.matches(docs, bench).count() == 0
        if name == "pii":
            assert docs.count() == before.count() and all(base_spans(t) == "" for _, t in texts(docs))
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).select("doc_id").distinct().count() == docs.count()
