"""WARC archives: written by Spark's text sink, read back in byte ranges by boundary-chain verification.

Writing: a record is one string (header lines, blank line, payload); the sink ends each with the blank lines that WARC
asks for. Of records with equal payloads of at least ``REVISIT_BYTES`` bytes the one with the smallest page_id carries the
payload, the others are revisit records that name it. Who carries it is decided on digests, and joined to the payloads once.

Reading: files are read in byte ranges of the session's partition size, however large they are, by Spark's text source with
the magic line as its separator. Every place behind a magic line, payloads included, is a candidate, and the task emits the offset
at which the next record would start; offsets are running sums inside a range and over the ranges of a file. Only the
start of a file is known to be a record; pointer jumping from it, in log2(records of a file) rounds, crosses the ranges, keeps
what is reachable and thereby rejects magic lines inside payloads. Payloads that hold magic lines are put together again from
their pieces, those behind the record up to the next true one. All of it is DataFrame functions; a task holds one record.

Defined cases: a null html is an empty payload and a response; rows with equal page_id and payload become one response and
revisits of it; a null page_id sorts last and is named by an empty id; null and odd urls are written percent-encoded where
they hold blanks or line ends; extra columns are ignored; an empty table writes no record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ladle import session
from ladle.llm import common
from ladle.operators.ordered import previous_value

REVISIT_BYTES = 100
END = "\r\n\r\n"
MAGIC = "WARC/1.1\r\n"


def write(pages: DataFrame, path: str) -> None:
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("body"))
    rows = rows.withColumns({"size": F.octet_length("body").cast("long"), "digest": F.sha2("body", 256)})
    # Ties of page_id are settled by the url; of fully equal rows any one carries the payload.
    own = F.struct(F.col("page_id").isNull().alias("none"), F.col("page_id").alias("id"), F.coalesce("url", F.lit("")).alias("url"))
    seen = rows.filter(F.col("size") >= REVISIT_BYTES).select("digest", own.alias("own")).groupBy("digest", "own").agg(F.count("*").alias("n"))
    first = common.stage(seen.groupBy("digest").agg(F.min(F.struct("own", "n")).alias("first"), F.sum("n").alias("copies")).filter("copies > 1").select(
        "digest", F.col("first.own").alias("first"), F.col("first.n").alias("same")), "copies")
    joined = rows.join(first, "digest", "left")
    # Equal rows of which one would carry the payload are all written as revisits; the one that carries it is added.
    revisit = F.col("first").isNotNull() & (~(own == F.col("first")) | (F.col("same") > 1))
    records = joined.withColumn("revisit", F.coalesce(revisit, F.lit(False)))
    twice = first.filter("same > 1")
    if not twice.isEmpty():
        carriers = rows.join(twice, "digest").filter(own == F.col("first")).dropDuplicates(["digest"]).withColumn("revisit", F.lit(False))
        spare = joined.filter((own == F.col("first")) & (F.col("same") > 1)).select("digest", "page_id", "url", "size", "first", "same").dropDuplicates(["digest"])
        again = spare.select("*", F.explode(F.sequence(F.lit(2).cast("long"), F.col("same")))).drop("col").withColumns({"body": F.lit(""), "revisit": F.lit(True)})
        records = records.filter(~F.coalesce((own == F.col("first")) & (F.col("same") > 1), F.lit(False))).unionByName(carriers).unionByName(again)
    url = F.regexp_replace(F.coalesce("url", F.lit("")), "[\\s\\x00-\\x1F\\x7F]", "%20")
    again, to = F.col("revisit"), F.coalesce(F.col("first.id").cast("string"), F.lit(""))
    head = [F.lit(f"{MAGIC}WARC-Type: "), F.when(again, F.lit("revisit")).otherwise(F.lit("response")),
            F.lit("\r\nWARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">\r\nWARC-Target-URI: "), url,
            F.lit("\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Payload-Digest: sha256:"), F.col("digest"),
            F.when(again, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: <urn:page:"), to, F.lit(">"))).otherwise(F.lit("")),
            F.lit("\r\nContent-Length: "), F.when(again, F.lit(0)).otherwise(F.col("size")).cast("string"), F.lit(END),
            F.when(again, F.lit("")).otherwise(F.col("body"))]
    with common.shuffles_deleted(pages.sparkSession):
        records.select(F.concat(*head).alias("value")).write.option("lineSep", END).text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """file, block (start of the byte range), seq (order within it) and value: what stands between two magic lines."""
    lines = spark.read.option("lineSep", MAGIC).text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq"), "value")


def _field(name: str):
    return F.trim(F.regexp_extract("head", f"(?i)(?:^|\r\n){name}: *([^\r\n]*)", 1))


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """file, pos of every magic line, next (where the next record would start, or null), what the header says, and ``found``: the
    digest of the payload if no magic line is in it."""
    split = F.instr("value", END)
    rows = _pieces(spark, path).withColumn("head", F.when(split > 0, F.substring_index("value", END, 1)))
    rows = rows.withColumns({"length": F.octet_length("value").cast("long"), "body_at": F.octet_length("head").cast("long") + 4,
                             "size": _field("Content-Length").try_cast("long")})
    inside = F.col("body_at") + F.col("size") + 4 <= F.col("length")
    found = F.when(inside, F.sha2(F.substring(F.col("value").cast("binary"), F.col("body_at").cast("int") + 1, F.col("size").cast("int")), 256))
    rows = common.stage(rows.select("file", "block", "seq", "length", "body_at", "size", _field("WARC-Type").alias("type"), _field("WARC-Record-ID").alias("id"),
                                    _field("WARC-Refers-To").alias("refers"), _field("WARC-Payload-Digest").alias("digest"), found.alias("found")), "pieces")
    step = F.col("length") + len(MAGIC)
    own = F.sum(step).over(Window.partitionBy("file", "block").orderBy("seq")) - step
    blocks = rows.groupBy("file", "block").agg(F.sum(step).alias("all")).withColumn(
        "before", F.sum("all").over(Window.partitionBy("file").orderBy("block")) - F.col("all")).drop("all")
    placed = rows.withColumn("own", own).join(blocks, ["file", "block"]).withColumn("pos", F.col("own") + F.col("before") - len(MAGIC)).filter("pos >= 0")
    return common.stage(placed.withColumn("next", F.col("pos") + len(MAGIC) + F.col("body_at") + F.col("size") + 4).select(
        "file", "block", "seq", "pos", "next", "body_at", "size", "type", "id", "refers", "digest", "found"), "candidates")


def reachable(edges: DataFrame) -> DataFrame:
    """(file, pos) on the chain from offset 0, given ``edges`` (file, pos, next); pointers double in every round."""
    jump = edges.filter("next IS NOT NULL").select("file", "pos", "next")
    seen = jump.filter("pos = 0").select("file", "pos")
    while True:
        step = seen.join(jump, ["file", "pos"]).select("file", F.col("next").alias("pos"))
        further = jump.alias("j").join(jump.select("file", F.col("pos").alias("next"), F.col("next").alias("far")), ["file", "next"]).select("file", "pos", F.col("far").alias("next"))
        # What is reached in an odd number of steps joins what is reached in an even one; ends of files have no record.
        seen = common.stage(seen.union(step).distinct(), "seen")
        jump = common.stage(further, "jump")
        if not jump.limit(1).count():
            return seen


def _joined_payloads(spark: SparkSession, path: str, found: DataFrame, true: DataFrame) -> DataFrame:
    """file, pos, whole: digests of the payloads that hold magic lines, from their pieces in order."""
    broken = true.filter("found IS NULL").select("file", "pos", "body_at", "size")
    covered = previous_value(found.select("file", "pos").join(true.select("file", "pos", F.col("pos").alias("record")), ["file", "pos"], "left").withColumn(
        "after", F.col("pos") + 1), "file", [F.col("after")], "record")
    owner = covered.select("file", "pos", F.coalesce("record", "_previous").alias("record")).join(broken.select("file", F.col("pos").alias("record")), ["file", "record"])
    where = found.select("file", "pos", "block", "seq").join(owner, ["file", "pos"])
    texts = _pieces(spark, path).join(where, ["file", "block", "seq"]).select("file", "record", "pos", "value")
    parts = texts.groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("pos", "value"))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["value"]), MAGIC).cast("binary")
    return parts.withColumnRenamed("record", "pos").join(broken, ["file", "pos"]).select(
        "file", "pos", F.sha2(F.substring(text, F.col("body_at").cast("int") + 1, F.col("size").cast("int")), 256).alias("whole"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every true record below ``path``."""
    found = candidates(spark, path)
    true = common.stage(found.join(reachable(found), ["file", "pos"]).filter("next IS NOT NULL"), "records")
    if not true.filter("found IS NULL").isEmpty():
        whole = common.stage(_joined_payloads(spark, path, found, true), "payloads")
        true = true.join(whole, ["file", "pos"], "left").withColumn("found", F.coalesce("found", "whole"))
    page = F.regexp_extract("id", r"^<urn:page:(-?[0-9]*)>$", 1)
    to = F.regexp_extract("refers", r"^<urn:page:(-?[0-9]*)>$", 1)
    number = lambda c: F.when(c != "", c).cast("long")
    true = true.select(number(page).alias("page_id"), F.col("size").alias("payload_bytes"), "found", F.regexp_replace("digest", "^sha256:", "").alias("digest"), F.col("type").alias("record_type"), number(to).alias("refers_to"))
    # A revisit has no payload of its own: its length is that of the response with its digest.
    again = true.filter("record_type = 'revisit'")
    size = true.filter("record_type = 'response'").groupBy(F.col("found").alias("digest")).agg(F.max("payload_bytes").alias("full"))
    plain = true.filter("record_type = 'response'").select("page_id", "payload_bytes", F.col("found").alias("payload_digest"), "record_type", "refers_to")
    return plain.unionByName(again.join(size, "digest").select("page_id", F.col("full").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to"))


def round_trip(pages: DataFrame) -> DataFrame:
    path = session.shared_dir(pages.sparkSession, "warc")
    write(pages, path)
    return read(pages.sparkSession, path)
