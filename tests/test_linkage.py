import itertools
import random

import pytest
from pyspark.sql import functions as F

from ladle.operators import linkage
from ladle.operators.linkage import Block, Field

FIELDS = [Field("name", close=1), Field("city"), Field("tax", common=5)]
BLOCKS = [Block("array(tax)", ("name",)), Block("split(name, ' ')", ("city", "name"))]
SCHEMA = "id long, name string, city string, tax string"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def levels(x, y):
    def one(f, a, b):
        if a is None or b is None:
            return linkage.MISSING
        if a == b:
            return linkage.EQUAL
        return linkage.CLOSE if f.close and edits(a, b) <= f.close else linkage.DIFFERS
    return tuple(one(f, a, b) for f, a, b in zip(FIELDS, x, y))


def parties(n=120, seed=3):
    rnd, rows = random.Random(seed), []
    for k in range(n):
        name = "".join(rnd.choices("abcdefgh", k=7)) + " " + "".join(rnd.choices("klmnop", k=6))
        city, tax = f"c{k * 7 % 60}", f"t{k}"
        rows.append((name, city, tax))
        if k % 2 == 0:
            rows.append((name[:-1], city, tax if k % 4 else None))
        if k % 3 == 0:
            rows.append((name, city, "none"))
    return [(i, *r) for i, r in enumerate(rows)]


def clusters(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_entities_equal_all_pairs_scored_by_the_learned_weights(spark):
    rows = parties()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    profiles, _ = linkage._profiles(df, "id", FIELDS)
    weights = linkage.learn(profiles, linkage.candidates(profiles, FIELDS, BLOCKS), FIELDS)
    # The filler stands with more than five names, so it is missing.
    clean = {i: (n, c, None if t == "none" else t) for i, n, c, t in rows}
    bound = linkage.log(0.9 / 0.1)
    links = [(a, b) for a, b in itertools.combinations(clean, 2) if linkage.total(weights, levels(clean[a], clean[b])) >= bound]
    got = {r.id: r.entity_id for r in linkage.resolve(df, "id", FIELDS, BLOCKS).collect()}
    assert got == clusters(clean, links)
    assert len(set(got.values())) == 120


def test_candidates_are_the_pairs_that_share_a_block_and_hot_blocks_split(spark):
    rows = [(i, f"same w{i % 60}", f"c{i % 7}", None) for i in range(420)]
    profiles = spark.createDataFrame(rows, "profile long, name string, city string, tax string")
    got = {(r.a, r.b) for r in linkage.candidates(profiles, FIELDS, BLOCKS, limit=40).collect()}
    # "same" is hot as a word and hot with its city (60 profiles each), so it splits down to the name; "w7" holds 7 profiles.
    assert got == {(a[0], b[0]) for a, b in itertools.combinations(rows, 2) if a[1] == b[1]}
    # With a larger limit the block of word and city is small enough and all its pairs are compared.
    more = linkage.candidates(profiles, FIELDS, BLOCKS, limit=60).count()
    assert more == sum(1 for a, b in itertools.combinations(rows, 2) if a[1] == b[1] or a[2] == b[2])


def test_pairs_of_a_block_that_stays_hot_grow_with_its_size(spark):
    counts = []
    for n in (200, 400):
        rows = [(i, "acme", "c", f"t{i}") for i in range(n)]
        profiles = spark.createDataFrame(rows, "profile long, name string, city string, tax string")
        counts.append(linkage.candidates(profiles, FIELDS, BLOCKS, limit=40).count())
    assert counts == [199, 399]


def test_copies_fold_to_one_profile_and_records_that_say_nothing_stay_apart(spark):
    rows = [(i, "acme works", "c1", "t1") for i in range(300)] + [(1000 + i, "", None, " ") for i in range(300)]
    rows += [(2000 + i, *r[1:]) for i, r in enumerate(parties(60, 8))]
    got = {r.id: (r.entity_id, r.members) for r in linkage.resolve(spark.createDataFrame(rows, SCHEMA), "id", FIELDS, BLOCKS).collect()}
    assert len(got) == len(rows)
    assert all(got[i] == (0, 300) for i in range(300))
    assert all(got[1000 + i] == (1000 + i, 1) for i in range(300))


def test_empty_table(spark):
    assert linkage.resolve(spark.createDataFrame([], SCHEMA), "id", FIELDS, BLOCKS).collect() == []


def test_components_of_chains_and_stars(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000)]
    edges += [(rnd.randint(2000, 2300), rnd.randint(2000, 2300)) for _ in range(150)]
    rnd.shuffle(edges)
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    got = {r.node: r.root for r in linkage.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == clusters(nodes, [e for e in edges if e[0] != e[1]])


@pytest.mark.parametrize("text, want", [("Stahl-Werk GmbH", ["stahl", "werk"]), ("ltd", []), (None, None), ("Öl & Gas", ["gas", "öl"])])
def test_words(spark, text, want):
    df = spark.createDataFrame([(text,)], "name string").select(linkage.words("name", ["gmbh", "ltd"]).alias("w"))
    assert df.first()["w"] == want
    assert df.select(F.array_join("w", " ")).count() == 1
