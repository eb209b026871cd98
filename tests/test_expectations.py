import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ladle.operators import expectations as ex
from ladle.operators import quality

RULES = {"pos": "v > 0", "named": "n IS NOT NULL"}


@pytest.fixture
def df(spark):
    return spark.createDataFrame([(1, 5, "a"), (2, -1, "b"), (3, None, "c"), (4, 7, None), (5, None, None)], "id int, v int, n string")


def test_null_rule_result_is_a_failure_and_counts_add_up(df):
    obs = Observation("o")
    kept = ex.drop_failing(df, RULES, obs)
    assert [r.id for r in kept.collect()] == [1]
    assert obs.get == {"rows_read": 5, "pos": 3, "named": 2}
    assert {r.rule: (r.total, r.failed) for r in ex.violation_counts(df, RULES).collect()} == {"pos": (5, 3), "named": (5, 2)}


def test_split_covers_every_row_once(df):
    good, bad = ex.split(df, RULES)
    assert {r.id for r in good.collect()} == {1}
    assert {r.id: r.failed_rules for r in bad.collect()} == {2: ["pos"], 3: ["pos"], 4: ["named"], 5: ["pos", "named"]}


def test_scores_per_record(df):
    assert {r.id: r.dq_score for r in ex.flag(df, RULES).collect()} == {1: 1.0, 2: 0.5, 3: 0.5, 4: 0.5, 5: 0.0}


def test_cap_is_exact_and_deterministic(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("g"), "id").repartition(7)
    got = ex.cap_per_group(rows, ["g"], ["id"], 10, salts=8).groupBy("g").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    ids = {r.g: r.ids for r in got.collect()}
    assert ids["cold"] == [i for i in range(5000) if i % 3 == 0][:10]
    assert ids["hot"] == [i for i in range(5000) if i % 3 > 0][:10]


DQ = [("s.t", "VALIDITY", "v > 0", 0.5), ("s.t", "UNIQUENESS", None, 0.9), ("s.t", "COMPLETENESS", "n IS NOT NULL", 1.0)]


def dq_frame(spark, rows):
    return spark.createDataFrame(rows, "hk string, effective_ts timestamp_ntz, v int, n string")


def test_scores_against_hand_count(spark):
    from datetime import datetime
    t = datetime(2000, 1, 1)
    rows = [("a", t, 1, "x"), ("a", t, 1, "x"), ("b", t, None, "x"), (None, None, 3, None), (None, None, -3, "y")]
    run_at = F.lit("2000-01-02").cast("timestamp_ntz")
    got = {r.dimension: (r.total, r.passed, r.score, r.met_threshold)
           for r in quality.score_run(dq_frame(spark, rows), "s.t", DQ, "r1", run_at).collect()}
    assert got == {"VALIDITY": (5, 3, 0.6, True), "UNIQUENESS": (5, 3, 0.6, False), "COMPLETENESS": (5, 4, 0.8, False)}


def test_empty_table_scores_one_and_passes_the_gate(spark):
    run_at = F.lit("2000-01-02").cast("timestamp_ntz")
    out = quality.score_run(dq_frame(spark, []), "s.t", DQ, "r1", run_at)
    assert {(r.total, r.score, r.met_threshold) for r in out.collect()} == {(0, 1.0, True)}
    quality.gate(out)


def test_gate_lists_breaches(spark):
    bad = spark.createDataFrame([("t", "VALIDITY", False), ("t", "ACCURACY", True)], "table_name string, dimension string, met_threshold boolean")
    with pytest.raises(quality.QualityBreach, match="VALIDITY"):
        quality.gate(bad)


def test_gate_lists_every_breach(spark):
    bad = spark.range(1500).selectExpr("concat('t', id) AS table_name", "'VALIDITY' AS dimension", "FALSE AS met_threshold")
    with pytest.raises(quality.QualityBreach) as e:
        quality.gate(bad)
    assert str(e.value).count("VALIDITY") == 1500


def test_requeue_keeps_the_last_rejected(spark):
    rows = [('{"id":1,"c":"EUR"}', 1), ('{"id":1,"c":"GBP"}', 3), ('{"id":1,"c":"CAD"}', 2)]
    for order in (rows, rows[::-1]):
        payloads = spark.createDataFrame(order, "record_payload string, rejected_at int")
        assert [r.c for r in quality.requeue(payloads, "id int, c string", {}, ["id"]).collect()] == ["GBP"]


def test_quarantine_totals_match_scores(spark):
    from datetime import datetime
    t = datetime(2000, 1, 1)
    rows = [(f"k{i}", t, (None if i % 4 == 0 else i - 10), (None if i % 5 == 0 else "x")) for i in range(40)]
    df = dq_frame(spark, rows)
    run_at = F.lit("2000-01-02").cast("timestamp_ntz")
    failed = {r.dimension: r.total - r.passed for r in quality.score_run(df, "s.t", DQ, "r1", run_at).collect() if r.dimension != "UNIQUENESS"}
    q = quality.quarantine(df, "s.t", DQ, F.lit("r1"), run_at, ["hk"])
    assert {r.dq_dimension: r["count"] for r in q.groupBy("dq_dimension").count().collect()} == failed
    assert q.select("reject_id").distinct().count() == q.count()
    assert q.select("layer").distinct().first()[0] == "s"


def test_dimension_tokens_first_match_wins(spark):
    names = ["valid_pk", "valid_ts", "good_quality", "fresh_ts", "uniq_row", "format_x", "other"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(quality.dimension_of(F.col("n"))).collect()] == [
        "COMPLETENESS", "VALIDITY", "ACCURACY", "TIMELINESS", "UNIQUENESS", "CONSISTENCY", "VALIDITY"]


def test_requeue_imputes_and_dedups(spark):
    payloads = spark.createDataFrame([('{"id":1,"c":null}',), ('{"id":1}',), ('{"id":2,"c":"EUR"}',)], "record_payload string")
    out = quality.requeue(payloads, "id int, c string", {"c": "USD"}, ["id"])
    assert {(r.id, r.c) for r in out.collect()} == {(1, "USD"), (2, "EUR")}
