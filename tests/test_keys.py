import hashlib

from pyspark.sql import functions as F

from ladle.functions.keys import content_hash, hash_key
from ladle.functions.scalars import date_to_day_serial, day_serial_to_date


def test_hash_key_is_plain_sha256_and_null_safe(spark):
    df = spark.createDataFrame([("SAP", "A", "B"), ("SAP", None, "B"), ("SAP", "AB", None)], "s string, a string, b string")
    rows = df.select(hash_key("s", "a", "b").alias("hk")).collect()
    assert rows[0].hk == hashlib.sha256(b"SAP|A|B").hexdigest()
    assert [r.hk for r in rows[1:]] == [None, None]


def test_hash_key_not_null_is_decided_without_hashing(spark):
    df = spark.range(3).select(F.lit("S").alias("s"), F.col("id").cast("string").alias("pk"))
    plan = df.withColumn("hk", hash_key("s", "pk")).filter("hk IS NOT NULL")._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert all("sha2" not in line for line in filters)


def test_content_hash_ignores_column_order_but_not_names(spark):
    df = spark.createDataFrame([("x", None)], "a string, b string")
    same = df.select(content_hash(["a", "b"]).alias("h1"), content_hash(["b", "a"]).alias("h2")).first()
    assert same.h1 == same.h2
    swapped = df.select(F.col("b").alias("a"), F.col("a").alias("b")).select(content_hash(["a", "b"]).alias("h")).first()
    assert swapped.h != same.h1


def test_day_serial_round_trip(spark):
    df = spark.sql("SELECT DATE '1900-01-01' AS d UNION ALL SELECT DATE '2001-08-01'")
    rows = df.select("d", date_to_day_serial(F.col("d")).alias("n")).withColumn("back", day_serial_to_date(F.col("n"))).collect()
    assert rows[0].n == 36525
    assert all(r.d == r.back for r in rows)
