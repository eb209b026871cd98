import random
from datetime import datetime, timedelta

from ladle.operators import features


def brute(labels, feats):
    out = {}
    for lid, key, at in labels:
        known = [f for f in feats if f[0] == key and f[1] <= at]
        best = max(known, key=lambda f: f[1]) if known else None
        out[lid] = (best[1], best[2]) if best else (None, None)
    return out


def test_asof_join_matches_brute_force_with_a_hot_key(spark):
    rnd = random.Random(3)

    def when():
        return datetime(2000, 1, 1) + timedelta(days=rnd.randint(0, 700))

    labels = [(i, "hot" if i % 3 == 0 else f"k{rnd.randint(1, 9)}", when()) for i in range(300)]
    feats = {}
    for i in range(120):
        key = rnd.choice(["hot", *[f"k{j}" for j in range(1, 8)]])
        feats[(key, when())] = i
    feats = [(k, t, v) for (k, t), v in feats.items()]
    left = spark.createDataFrame(labels, "lid int, key string, label_ts timestamp_ntz").repartition(4)
    right = spark.createDataFrame(feats, "key string, feature_ts timestamp_ntz, v int")
    for coalesce in ("true", "false"):   # one range, and several ranges per key
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
        got = features.asof_join(left, right, "key", "label_ts", "feature_ts", ["v"])
        assert {r.lid: (r.matched_ts, r.v) for r in got.collect()} == brute(labels, feats)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_asof_join_equal_time_hits_and_future_does_not_leak(spark):
    t = datetime(2000, 5, 5)
    left = spark.createDataFrame([(1, "a", t), (2, "a", t - timedelta(seconds=1)), (3, "none", t)], "lid int, key string, label_ts timestamp_ntz")
    right = spark.createDataFrame([("a", t, 7)], "key string, feature_ts timestamp_ntz, v int")
    got = {r.lid: r.v for r in features.asof_join(left, right, "key", "label_ts", "feature_ts", ["v"]).collect()}
    assert got == {1: 7, 2: None, 3: None}


def test_merge_replaces_same_key_and_time_only(spark):
    t = datetime(2000, 1, 1)
    old = spark.createDataFrame([("a", t, 1), ("b", t, 2)], "k string, ts timestamp_ntz, v int")
    new = spark.createDataFrame([("a", t, 9), ("a", t + timedelta(days=1), 3)], "k string, ts timestamp_ntz, v int")
    got = {(r.k, r.ts, r.v) for r in features.merge_versions(old, new, ["k", "ts"]).collect()}
    assert got == {("a", t, 9), ("a", t + timedelta(days=1), 3), ("b", t, 2)}
    assert features.absent_rows(old, new, ["k"]).count() == 0


def test_features_are_strictly_before_as_of(spark):
    rows = [("c", "o1", "2001-01-01", 10), ("c", "o2", "2001-08-02", 99), ("c", "o3", "1999-01-01", 5), (None, "o4", "2001-01-01", 1)]
    fact = spark.createDataFrame(rows, "customer_hk string, order_hk string, d string, a int").selectExpr(
        "customer_hk", "order_hk", "to_date(d) AS order_date", "cast(a AS decimal(20,4)) AS order_amount_usd")
    row = features.customer_features(fact, "2001-08-02").collect()
    assert len(row) == 1
    assert (float(row[0].ltv_usd), row[0].order_count_all, row[0].order_count_365d) == (15.0, 2, 1)
