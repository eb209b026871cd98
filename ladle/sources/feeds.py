"""Source feeds in the shape the outside systems deliver them, derived from the given tables.

Orders and customers arrive as change records in three ERP dialects; which system owns a record
follows from its customer, so that orders and customers of one system refer to each other. The
feeds carry the flaws the conformance and quality layers exist for: NULL keys and currencies,
an unknown currency, negative amounts, resent records, malformed country codes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ladle.functions.scalars import DAY_SERIAL_OFFSET
from ladle.sources.tables import table

CURRENCIES = "array('USD', 'EUR', 'GBP', 'CAD', 'JPY')"
KEY_WIDTH = 12
_META = ["op_type", "csn", "changed_at"]


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_changes_of(table(spark, sf_dir, "orders"))


def order_changes_of(orders: DataFrame) -> DataFrame:
    """Change log of orders: inserts, resent inserts, updates, deletes, re-inserts (csn orders a key).

    Every order explodes into its own changes, in one pass; batch or streaming alike.
    """
    steps = ("array(1, if(o_orderkey % 71 = 2, 1, NULL), if(o_orderkey % 5 = 0, 2, NULL), "
             "if(o_orderkey % 11 = 0, 3, NULL), if(o_orderkey % 55 = 0, 4, NULL))")
    price = "if(o_orderkey % 89 = 5, -cast(o_totalprice AS decimal(18,2)), cast(o_totalprice AS decimal(18,2)))"
    return (
        orders.selectExpr("*", f"explode({steps}) AS csn").filter("csn IS NOT NULL")
        .selectExpr(
            "o_orderkey AS order_no",
            "o_custkey % 3 AS owner",
            "if(o_orderkey % 113 != 9, o_custkey, NULL) AS cust_no",
            f"if(o_orderkey % 97 != 3, element_at({CURRENCIES}, cast(o_orderkey % 5 + 1 AS int)), NULL) AS currency",
            "cast(o_orderdate AS date) AS order_date",
            "CASE csn WHEN 1 THEN 'I' WHEN 3 THEN 'D' ELSE 'U' END AS op_type",
            "cast(csn AS bigint) AS csn",
            f"cast({price} + CASE csn WHEN 1 THEN 0 WHEN 4 THEN 250 ELSE 100 END AS decimal(18,2)) AS amount",
            "o_orderdate + make_dt_interval(csn - 1) AS changed_at",
        )
    )


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log of customers: a rename for some, and for fewer a later change that changes nothing."""
    steps = "array(1, if(c_custkey % 4 = 0, 2, NULL), if(c_custkey % 20 = 0, 3, NULL))"
    name = "if(c_custkey % 41 != 7, c_name, NULL)"
    return (
        table(spark, sf_dir, "customer").selectExpr("*", f"explode({steps}) AS csn").filter("csn IS NOT NULL")
        .selectExpr(
            "c_custkey AS cust_no", "c_custkey % 3 AS owner", "c_nationkey", "c_mktsegment",
            "if(c_custkey % 53 = 0, 'xx', concat(char(65 + c_nationkey % 26), char(65 + (c_nationkey * 7) % 26))) AS country",
            "if(csn = 1, 'I', 'U') AS op_type",
            "cast(csn AS bigint) AS csn",
            f"if(csn = 1, {name}, concat({name}, ' Ltd')) AS name",
            "timestamp_ntz'2000-01-01 00:00:00' + make_dt_interval(cast(c_custkey % 28 AS int) + (csn - 1) * 30) AS changed_at",
        )
    )


def _padded(prefix: str, key: str) -> str:
    return f"concat('{prefix}', lpad(cast({key} AS string), {KEY_WIDTH}, '0'))"


def order_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """One frame per ERP order table, keyed by its Bronze name."""
    return order_feeds_of(order_changes(spark, sf_dir))


def order_feeds_of(changes: DataFrame) -> dict[str, DataFrame]:
    material = "concat('MAT-', cast(order_no % 6 AS string))"
    serial = f"datediff(order_date, DATE'1900-01-01') + {DAY_SERIAL_OFFSET}"
    sap = changes.filter("owner = 0").selectExpr(
        "concat('00', cast(order_no + 4000000 AS string)) AS VBELN", f"{_padded('EU', 'cust_no')} AS KUNNR",
        "amount AS NETWR", "currency AS WAERK", "cast(order_date AS string) AS ERDAT", f"{material} AS MATNR", *_META)
    jde = changes.filter("owner = 1").selectExpr(
        "'00001' AS SHKCOO", "order_no + 100000 AS SHDOCO", "'SO' AS SHDCTO", "cust_no + 10000 AS SHAN8",
        "cast(amount * 100 AS bigint) AS SHOTOT", "currency AS SHCRCD", f"{serial} AS SHTRDJ", f"{material} AS SHLITM", *_META)
    qad = changes.filter("owner = 2").selectExpr(
        "'EMEA' AS so_domain", "concat('SO', cast(order_no + 700000 AS string)) AS so_nbr", f"{_padded('ME', 'cust_no')} AS so_cust",
        "amount AS so_t_amt", "currency AS so_curr", "cast(order_date AS string) AS so_ord_date", f"{material} AS so_part", *_META)
    return {"bronze.sap.vbak": sap, "bronze.jde.f4201": jde, "bronze.qad.so_mstr": qad}


def customer_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The two mapped customer dialects. The third system delivers no customer table."""
    changes = customer_changes(spark, sf_dir)
    sap = changes.filter("owner = 0").selectExpr(
        f"{_padded('EU', 'cust_no')} AS KUNNR", "name AS NAME1", "country AS LAND1", *_META)
    jde = changes.filter("owner = 1").selectExpr(
        "cust_no + 10000 AS ABAN8", "name AS ABALPH", "country AS ABCTR", *_META)
    return {"bronze.sap.kna1": sap, "bronze.jde.f0101": jde}


# Event type of the events table to plant area, tag and topic suffix.
PLANT_AREAS = [("view", "meltshop"), ("click", "meltshop"), ("error", "caster"),
               ("purchase", "rollmill/mes"), ("signup", "utilities")]
PLANT_TAGS = [("view", "temperature"), ("click", "power_kw"), ("error", "mold_level"), ("signup", "flow")]
SITES = ["north", "south", "west"]


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _case(col: Column, pairs: list[tuple[str, str]]) -> Column:
    out = F.when(col == pairs[0][0], F.lit(pairs[0][1]))
    for key, value in pairs[1:]:
        out = out.when(col == key, F.lit(value))
    return out


def broker_records(events: DataFrame) -> DataFrame:
    """Events as broker records ``(topic, value, timestamp)``; batch or streaming alike."""
    kind, grade = F.col("event_type"), F.get_json_object("props", "$.k").cast("int")
    site = _pick(SITES, F.col("user_id") % 3)
    ts = F.col("ts").cast("timestamp")
    asset = F.concat(F.lit("asset"), F.col("user_id").cast("string"))
    mes_event = F.when(F.col("event_id") % 2 == 0, F.lit("start")).otherwise(F.lit("complete"))
    quality = F.when(grade < 3, "BAD").when(grade < 10, "UNCERTAIN").otherwise("GOOD")
    telemetry = F.to_json(F.struct(
        asset.alias("deviceID"), _case(kind, PLANT_TAGS).alias("tagName"), F.col("value"),
        F.unix_millis(ts).alias("timestamp"), quality.alias("quality"),
        F.create_map(F.lit("grade"), grade.cast("string")).alias("metadata")))
    mes = F.to_json(F.struct(
        F.concat(F.lit("WO"), (F.col("event_id") + 80000).cast("string")).alias("work_order_id"),
        mes_event.alias("event"), F.concat(F.lit("MAT-"), (F.col("user_id") % 6).cast("string")).alias("product"),
        F.unix_millis(ts).alias("ts")))
    is_mes = kind == "purchase"
    leaf = F.when(is_mes, F.concat(F.lit("order_"), mes_event)).otherwise(
        F.concat_ws("/", asset, _case(kind, PLANT_TAGS)))
    return events.select(
        F.concat_ws("/", F.lit("plant"), site, _case(kind, PLANT_AREAS), leaf).alias("topic"),
        F.when(is_mes, mes).otherwise(telemetry).alias("value"), ts.alias("timestamp"))


FILLER_TAX = "000000000"


def party_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as three systems know them: record_id, source_system, name, post_code, nation, tax_id.

    The first system knows all, the second every other and the third every third customer. Names lose a letter, change case, legal
    form and the order of words; a digit of some post codes is wrong; tax numbers are absent or a filler that many share; and
    some customers bear another customer's name. Records of customer k have ids from 3 * k.
    """
    base = table(spark, sf_dir, "customer").selectExpr("c_custkey AS k", "cast(c_nationkey AS string) AS nation").selectExpr(
        "k", "nation", "md5(cast(if(k % 29 = 0, k + 1, k) AS string)) AS h", "lpad(cast(k * 7919 % 100000 AS string), 5, '0') AS post",
        "concat('T', substr(md5(concat('tax', k)), 1, 12)) AS tax").selectExpr(
        "*", "translate(substr(h, 1, 7), '0123456789abcdef', 'bdfgklmnprstvzae') AS w1",
        "translate(substr(h, 9, 6), '0123456789abcdef', 'bdfgklmnprstvzae') AS w2")
    sap = base.selectExpr("k * 3 AS record_id", "'SAP' AS source_system", "concat(initcap(w1), ' ', initcap(w2), ' GmbH') AS name",
                          "post AS post_code", "nation", "if(k % 10 = 3, NULL, tax) AS tax_id")
    jde = base.filter("k % 2 = 0").selectExpr(
        "k * 3 + 1", "'JDE'", "concat(upper(if(k % 4 = 0, concat(substr(w1, 1, 4), substr(w1, 6)), w1)), ' ', upper(w2), ', LTD.')",
        "post", "nation", "if(k % 6 = 0, NULL, tax)")
    qad = base.filter("k % 3 = 0").selectExpr(
        "k * 3 + 2", "'QAD'", "concat(w2, ' ', w1)",
        "if(k % 9 = 0, concat(substr(post, 1, 4), cast((cast(substr(post, 5) AS int) + 1) % 10 AS string)), post)", "nation",
        f"if(k % 5 = 0, tax, '{FILLER_TAX}')")
    return sap.union(jde).union(qad)
