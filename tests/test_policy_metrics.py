import pytest
from pyspark.sql import functions as F

from ladle.operators import policy
from ladle.operators.metrics import SALES_METRICS
from ladle.sources import seeds

ROWS = [("SAP",), ("JDE",), ("EBS",), ("QAD",), ("D365",), (None,)]


@pytest.mark.parametrize("roles,want", [
    ([], {"D365"}), (["sales_analyst_europe"], {"SAP", "D365"}),
    (["sales_analyst_americas", "sales_analyst_emea"], {"JDE", "EBS", "QAD", "D365"}),
    (["data_steward"], {"D365"}), (["data_engineer"], {"SAP", "JDE", "EBS", "QAD", "D365", None}),
])
def test_row_filter_by_role_and_same_as_sql_function(spark, roles, want):
    df = spark.createDataFrame(ROWS, "source_system string")
    assert {r[0] for r in policy.filter_rows(df, roles).collect()} == want
    policy.register_sql_functions(spark)
    literal = "array(" + ", ".join(f"'{r}'" for r in roles) + ")" if roles else "cast(array() AS array<string>)"
    assert {r[0] for r in df.filter(F.expr(f"region_filter(source_system, {literal})")).collect()} == want


def test_masks(spark):
    df = spark.createDataFrame([("Meyer", "m@x.org", 5.0), (None, None, None)], "n string, e string, a double")
    row = df.select(policy.mask_name([], F.col("n")).alias("n"), policy.mask_email("r", F.col("e")).alias("e"),
                    policy.mask_amount("r", F.col("a")).alias("a"), policy.mask_pii_text("r", F.col("n")).alias("p")).collect()
    assert tuple(row[0]) == ("Me*****", "****@x.org", -1.0, "***-MASKED-***")
    assert row[1].n is None and row[1].p is None
    assert df.select(policy.mask_name(["data_steward"], F.col("n"))).first()[0] == "Meyer"


def test_tag_masking_masks_only_tagged_columns(spark):
    tags = seeds.inline(spark, [("t", "n", "pii", "name"), ("u", "a", "pii", "x")],
                        "table_name string; column_name string; tag_name string; tag_value string")
    df = spark.createDataFrame([("Meyer", 5)], "n string, a int")
    assert tuple(policy.mask_tagged(df, "t", tags, []).first()) == ("Me*****", 5)


def test_metric_view_any_grain_and_synonyms(spark):
    rows = [("SAP", "c1", "o1", 10.0), ("SAP", "c1", "o2", 30.0), ("JDE", None, "o3", 5.0), ("JDE", "c2", "o4", None)]
    fact = spark.createDataFrame(rows, "source_system string, customer_hk string, order_hk string, order_amount_usd double")
    total = SALES_METRICS.query(fact, ["total sales", "aov", "active_customers"]).first()
    assert tuple(total) == (45.0, 15.0, 1)
    by = {r.source_system: r.order_count for r in SALES_METRICS.query(fact, ["number of orders"], ["ERP"]).collect()}
    assert by == {"SAP": 2, "JDE": 1}
    with pytest.raises(KeyError):
        SALES_METRICS.resolve("unknown")


def test_metric_cuts_of_kept_cells_equal_plain_aggregates_without_expand(spark, tmp_path):
    """Null keys and dimensions, an order of several customers, an empty source; one read of the fact for all cuts."""
    spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'SAP' WHEN id % 7 > 0 THEN 'JDE' END AS source_system", "CASE WHEN id % 5 > 0 THEN concat('c', id * id % 37) END AS customer_hk",
        "CASE WHEN id % 11 > 0 THEN concat('o', id % 700) END AS order_hk", "CAST(id % 13 AS DECIMAL(20,4)) AS order_amount_usd", "DATE'2024-01-01' + CAST(id % 4 AS INT) AS order_date",
    ).write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    fact.createOrReplaceTempView("metric_fact")
    measures = ["revenue_usd", "order_count", "avg_order_value", "active_customers"]
    cells = SALES_METRICS.cells(fact, measures, [["order_date", "erp"], ["customer"], []])
    cells.write.parquet(str(tmp_path / "cells"))
    cells = spark.read.parquet(str(tmp_path / "cells"))
    for by, columns in ((["order_date", "erp"], "order_date, source_system"), (["customer"], "customer_hk AS customer"), (["erp"], "source_system"), ([], "")):
        got = SALES_METRICS.cut(cells, measures, by)
        assert "Expand" not in got._jdf.queryExecution().toString()
        want = spark.sql(f"""SELECT {columns + ',' if columns else ''} SUM(order_amount_usd), COUNT(DISTINCT order_hk), SUM(order_amount_usd) / COUNT(DISTINCT order_hk), COUNT(DISTINCT customer_hk)
                             FROM metric_fact {'GROUP BY ALL' if columns else ''}""")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    every = SALES_METRICS.lattice(fact, measures, [["erp"], []]).collect()
    assert {r["cut"] for r in every} == {"source_system", ""} and len(every) == 4
    assert tuple(SALES_METRICS.query(fact.limit(0), measures).first()) == (None, 0, None, 0)


def test_key_that_is_a_dimension_is_held_once(spark):
    fact = spark.createDataFrame([("o1", "c1", "S", 1), ("o2", "c1", "S", 2), ("o3", None, "S", 4), ("o3", "c2", "T", None)],
                                 "order_hk string, customer_hk string, source_system string, order_amount_usd long").withColumn("order_date", F.lit(None).cast("date"))
    measures = ["revenue_usd", "order_count", "active_customers"]
    assert set(SALES_METRICS.cells(fact, measures, [["customer"], []]).columns) == {"customer", "orders", "amount"}
    assert set(SALES_METRICS.cells(fact, measures, [["erp"]]).columns) == {"source_system", "orders", "customers", "amount"}
    rows = SALES_METRICS.lattice(fact, measures, [["customer"], []]).collect()
    assert sorted(map(tuple, rows), key=str) == sorted([("customer", "c1", 3, 2, 1), ("customer", None, 4, 1, 0), ("", None, 7, 3, 1)], key=str)


def test_counted_keys_stay_different_in_fewer_bytes(spark):
    keys = ["ab" * 32, "AB" * 32, "ab" * 31 + "cd", "", "0", "00", "abc", "0abc", "zz", "é", "\x00", "\x01", "01", "0100"]
    fact = spark.createDataFrame([(k, "c", "S", 1) for k in [*keys, *keys, None]], "order_hk string, customer_hk string, source_system string, order_amount_usd long")
    cells = SALES_METRICS.cells(fact, ["order_count"], [["erp"]])
    assert sorted(len(r["orders"]) for r in cells.filter("orders IS NOT NULL").collect())[-3:] == [33, 33, 65] and cells.count() == len(keys) + 1
    assert SALES_METRICS.query(fact, ["order_count"], ["erp"]).first()["order_count"] == len(keys)
    numbers = fact.withColumn("order_hk", F.length("order_hk"))
    assert dict(SALES_METRICS.cells(numbers, ["order_count"], [["erp"]]).dtypes)["orders"] == "int"
