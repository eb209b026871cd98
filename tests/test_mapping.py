from pyspark.sql import functions as F

from ladle.operators import mapping
from ladle.sources import seeds

ROWS = [
    ("m1", "silver", "b.x", "K", "t", "id", None, None, 1, "2000-01-01", None, "a", "string"),
    ("m2", "silver", "b.x", "V", "t", "val", None, None, 1, "2000-01-01", None, "a", "int"),
    ("m3", "silver", "b.x", "V", "t", "val", "V * 2", None, 2, "2000-02-01", None, "a", "int"),
    ("m4", "silver", "b.x", "V", "t", "val", "V * 9", None, 3, "2000-03-01", "2000-04-01", "a", "int"),
    ("m5", "silver", "b.y", "N", "t", "id", None, None, 1, "2000-01-01", None, "a", "string"),
    ("m6", "silver", "b.y", None, "t", "extra", "'only y'", None, 1, "2000-01-01", None, "a", "string"),
]


def maps(spark):
    return seeds.inline(spark, ROWS, seeds.MAPPING_SCHEMA)


def test_highest_open_version_wins_and_retired_rows_are_out(spark):
    got = {(s, c): e for s, cols in mapping.load_projections(maps(spark), "t") for c, e, _ in cols}
    assert got == {("b.x", "id"): "K", ("b.x", "val"): "V * 2", ("b.y", "id"): "N", ("b.y", "extra"): "'only y'"}


def test_union_casts_mixed_key_types_and_fills_missing_columns(spark):
    x = spark.createDataFrame([("EU00001", 3)], "K string, V int")
    y = spark.createDataFrame([(10001,)], "N int")
    out = mapping.conform({"b.x": x, "b.y": y}, maps(spark), "t")
    rows = {r.id: (r.val, r.extra) for r in out.collect()}
    assert rows == {"EU00001": (6, None), "10001": (None, "only y")}


def test_version_diff(spark):
    two = maps(spark).filter("src_table = 'b.x'")
    diff = {(r.tgt_column, r.change) for r in mapping.diff_versions(two, 1, 2).collect()}
    assert diff == {("val", "changed"), ("id", "removed")}


def test_seed_has_all_mappings(spark):
    edges = mapping.edges(seeds.layer_mappings(spark))
    assert edges.count() == 26
    assert edges.filter(F.col("src_table") == "bronze.jde.f4201").count() == 6
