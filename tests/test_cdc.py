import random

import pytest
from pyspark.sql import functions as F

from ladle.operators import cdc
from ladle.streaming import jobs

# key, op, csn, value: late lower sequences, delete then re-insert, delete of an unknown key.
CHANGES = [
    (1, "I", 1, "a"), (1, "U", 3, "c"), (1, "U", 2, "b"),
    (2, "I", 1, "a"), (2, "D", 5, "x"), (2, "U", 4, "late"),
    (3, "I", 1, "a"), (3, "D", 2, "x"), (3, "I", 3, "again"),
    (4, "D", 9, "x"),
    (5, None, 1, "no op code"),
]
SCHEMA = "k int, op_type string, csn bigint, v string"
MIRROR = {1: "c", 3: "again", 5: "no op code"}


@pytest.mark.parametrize("seed", range(4))
def test_mirror_does_not_depend_on_arrival_order(spark, seed):
    rows = CHANGES[:]
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert {r.k: r.v for r in cdc.scd1_mirror(df, ["k"], "csn").collect()} == MIRROR


@pytest.mark.parametrize("splits", [1, 3, len(CHANGES)])
def test_stream_mirror_does_not_depend_on_batch_split(spark, tmp_path, splits):
    rows = CHANGES[:]
    random.Random(splits).shuffle(rows)
    for i in range(splits):
        spark.createDataFrame(rows[i::splits], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    base = str(tmp_path / "job")
    jobs.mirror_changes(stream, ["k"], "csn", base).awaitTermination()
    assert {r.k: r.v for r in jobs.read_mirror(spark, ["k"], "csn", base).collect()} == MIRROR


def test_partial_aggregation_precedes_the_shuffle(spark):
    df = spark.createDataFrame(CHANGES, SCHEMA)
    plan = cdc.net_changes(df, ["k"], "csn")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max_by") > plan.index("Exchange")  # plans print top-down


def test_snapshot_diff(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "z"), (4, "n"), (3, None)], "k int, v string")
    got = {(r.k, r.change_type) for r in cdc.snapshot_diff(a, b, ["k"], ["v"]).collect()}
    assert got == {(2, "update"), (4, "insert")}
    assert {(r.k, r.change_type) for r in cdc.snapshot_diff(b, a, ["k"], ["v"]).collect()} == {(2, "update"), (4, "delete")}


def test_cursor_pull_reaches_the_scan(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    pulled = cdc.since_cursor(orders, "o_orderdate", "2000-06-30 00:00:00")
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate" in pulled._jdf.queryExecution().executedPlan().toString()
    mark = cdc.next_high_water(pulled, "o_orderdate")
    assert cdc.since_cursor(orders, "o_orderdate", mark).count() == 0
    assert cdc.since_cursor(orders, "o_orderdate", None).count() == orders.count()
    assert pulled.filter(F.col("o_orderdate") <= F.lit("2000-06-30").cast("timestamp_ntz")).count() == 0
