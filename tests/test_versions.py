import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ladle.operators import ordered, versions

SCHEMA = "hk string, effective_ts timestamp_ntz, csn bigint, record_hash string"


def history(n=600, seed=5):
    """One key holds a third of all rows; content repeats, times tie."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else f"k{rnd.randint(1, 40)}"
        at = datetime(2000, 1, 1) + timedelta(days=rnd.randint(0, 400), hours=rnd.choice([0, 12]))
        rows.append((key, at, i, rnd.choice("abc")))
    return rows


def expected(rows):
    by_key = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        by_key.setdefault(r[0], []).append(r)
    return by_key


def test_noop_suppression_matches_brute_force(spark):
    rows = history()
    want = set()
    for log in expected(rows).values():
        want |= {r for p, r in zip([None, *log], log) if p is None or p[3] != r[3]}
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = {tuple(r) for r in versions.drop_noops(df, ["effective_ts", "csn"]).collect()}
    assert got == want


def test_noop_suppression_when_the_hot_key_changed_at_one_instant(spark):
    at = datetime(2000, 1, 1)
    rows = [("hot", at, i, "ab"[(i // 7) % 2]) for i in range(500)] + [(f"k{i}", at, i, "a") for i in range(500)]
    got = versions.drop_noops(spark.createDataFrame(rows, SCHEMA).repartition(5), ["effective_ts", "csn"])
    assert got.filter("hk = 'hot'").count() == 72 and got.filter("hk <> 'hot'").count() == 500


def test_intervals_match_brute_force(spark):
    rows = history(seed=9)
    want = set()
    for log in expected(rows).values():
        want |= {(r[0], r[2], r[1], n[1] if n else None) for r, n in zip(log, [*log[1:], None])}
    out = versions.validity_intervals(spark.createDataFrame(rows, SCHEMA), ["effective_ts", "csn"])
    assert {(r.hk, r.csn, r.valid_from, r.valid_to) for r in out.collect()} == want
    assert out.filter("is_current <> (valid_to IS NULL)").count() == 0


def test_current_is_deterministic_and_limited_before_the_shuffle(spark):
    at = datetime(2000, 1, 1)
    df = spark.createDataFrame([("a", at, 1, "x"), ("a", at, 2, "y"), ("a", at, 2, "w"), ("b", at, 1, "q")], SCHEMA)
    got = versions.current_rows(df, "csn")
    assert {(r.hk, r.record_hash) for r in got.collect()} == {("a", "w"), ("b", "q")}
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()


def test_survivorship_takes_best_source_per_column(spark):
    df = spark.createDataFrame(
        [("m", "QAD", 9, "qad", "QQ"), ("m", "JDE", 1, "jde", "JJ"), ("m", "SAP", 1, None, "S1"), ("m", "SAP", 2, None, "S2")],
        "match string, source_system string, ts int, name string, country string")
    row = versions.survivor(df, ["match"], ["SAP", "JDE", "QAD"], ["name", "country"], ["ts"]).first()
    assert (row["name"], row["country"], row["contributors"]) == ("jde", "S2", 4)


def test_hot_key_is_cut_into_ranges(spark):
    """No task sweeps a whole hot key: its rows lie in several of the range partitions."""
    df = spark.createDataFrame(history(), SCHEMA)
    ranges = df.repartitionByRange(F.col("hk"), F.col("effective_ts"), F.col("csn")).withColumn("p", F.spark_partition_id())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert ranges.filter("hk = 'hot'").select("p").distinct().count() > 1
        got = versions.drop_noops(df, ["effective_ts", "csn"])
        want = sum(1 for log in expected(history()).values() for p, r in zip([None, *log], log) if p is None or p[3] != r[3])
        assert got.count() == want
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(hk" not in plan
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_scans_stay_in_the_jvm_and_split_one_instant(spark):
    """All rows of the hot key lie at one instant, yet several ranges hold them; no Python node is planned."""
    at = datetime(2000, 1, 1)
    df = spark.createDataFrame([("hot", at, i, f"h{i}") for i in range(900)] + [(None, at, i, "n") for i in range(5)], SCHEMA)
    got = ordered.previous_value(df, "hk", [F.col("effective_ts")], "record_hash")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan
    rows = got.collect()
    assert sum(r["_previous"] is None for r in rows if r.hk) == 1 and len({r["_previous"] for r in rows if r.hk}) == 900
    assert all(r["_previous"] is None for r in rows if r.hk is None)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert ordered._ranged(df, "hk", [F.col("effective_ts")], None).filter("hk = 'hot'").select("_scan_range").distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_row_numbers_match_brute_force(spark):
    rows = history(900) + [(None, datetime(2000, 1, 1), 5000 + i, "z") for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r.hk, r.csn): r.n for r in ordered.row_numbers(df, "hk", [F.col("effective_ts"), F.col("csn")], "n", cut_by=[F.col("effective_ts")]).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    by_key = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        by_key.setdefault(r[0], []).append(r)
    assert got == {(k, r[2]): i + 1 for k, log in by_key.items() for i, r in enumerate(log)}
