"""Benchmark decontamination: size-partitioned MinHash containment search, in DataFrame functions only.

Items fall into size classes (powers of two of their number of shingles). An item's sketch is its k smallest shingle
hashes. A document that contains a share t of the item's shingles contains each sketch value with probability t, however
long the document is, so long documents need no sketch: their shingles are probed against the index of sketch values. Each
class has the number of hits that a true container misses with probability below ``MISS``; an item of up to k shingles
is counted exactly. Candidates are verified on the full sets of shingle strings.

Words are the blank-separated strings of the lower-cased text. Defined cases: null or blank texts and items have no
shingles and match nothing; an item of one to four words is one shingle of its own length, looked for among all runs of that
length, also inside longer documents (documents are cut into such runs only if such items exist); repeated items and repeated documents are reported once per (doc_id, item_id); null ids are carried as they are; extra columns are
ignored here and kept by :func:`clean`. The index joins by broadcast only while Spark measures it as small.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.llm import common

WIDTH = 5
SKETCH = 24
MISS = 1e-9


def need(size: int, sketch: int, share: float) -> int:
    """Most hits that an item with ``share`` of its shingles in the text misses with probability below MISS."""
    if size <= sketch:
        return max(1, math.ceil(share * size - 1e-9))
    there, total, p, low = math.ceil(share * size - 1e-9), math.comb(size, sketch), 0.0, 0
    for hits in range(sketch + 1):
        p += math.comb(there, hits) * math.comb(size - there, sketch - hits) / total
        if p > MISS:
            break
        low = hits + 1
    return max(1, low)


def words(text: Column) -> Column:
    """The words of a text. Blanks are made plain spaces first: splitting at one character needs no regular expression."""
    plain = F.lower(F.coalesce(text, F.lit("")))
    for blank in "\t\n\x0b\x0c\r":
        plain = F.replace(plain, F.lit(blank), F.lit(" "))
    plain = F.when(F.contains(plain, F.lit("  ")), F.regexp_replace(plain, " {2,}", " ")).otherwise(plain)
    return F.split(F.trim(plain), " ", -1)


def shingles(df: DataFrame, *keep: str, strings: bool = False) -> DataFrame:
    """``keep`` and ``hash`` (or the ``shingle`` itself), one row for each run of WIDTH words of ``text``.

    Runs are zipped, exploded and hashed in generated code; no lambda runs once for each word.
    """
    w = F.col("_w")
    runs = F.arrays_zip(*[F.slice(w, i + 1, 1 << 30).alias(f"w{i}") if i else w.alias("w0") for i in range(WIDTH)])
    rows = (df.withColumn("_w", words(F.col("text"))).filter("_w[0] <> ''")
            .select(*keep, (F.size("_w") < WIDTH).alias("_short"), F.posexplode(runs).alias("_i", "_r")))
    parts = [F.col("_r")[f"w{i}"] for i in range(WIDTH)]
    value = F.concat_ws(" ", *parts).alias("shingle") if strings else F.xxhash64(*parts).alias("hash")
    return rows.filter(parts[-1].isNotNull() | (F.col("_short") & (F.col("_i") == 0))).select(*keep, value)


def index(items: DataFrame, share: float) -> DataFrame:
    """(hash, item_id, item_key, hits needed) for every value of every item's sketch."""
    each = shingles(items.select("item_id", "text", F.xxhash64("text").alias("item_key")), "item_id", "item_key")
    sized = each.groupBy("item_id", "item_key").agg(F.array_sort(F.collect_set("hash")).alias("h"))
    n = F.size("h")
    # The largest class any Spark array can reach is 2**31; each class uses the loosest bound of its sizes.
    low = F.when(n <= SKETCH, F.ceil(n * F.lit(share) - 1e-9))
    size = SKETCH
    while size < 1 << 12:
        ends = (size + 1, size * 2)
        low = low.when(n <= size * 2, F.lit(min(need(s, SKETCH, share) for s in range(ends[0], ends[1] + 1, max(1, size // 24)))))
        size *= 2
    low = low.otherwise(F.lit(need(1 << 14, SKETCH, share) - 1))
    return sized.select("item_id", "item_key", F.greatest(low, F.lit(1)).alias("need"),
                        F.explode(F.slice("h", 1, SKETCH)).alias("hash")).distinct()


def short_matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Items of one to ``WIDTH - 1`` words: each is one shingle of its own length, looked for among all runs of that length."""
    w = words(F.col("text"))
    short = items.select("item_id", w.alias("w")).filter(f"size(w) < {WIDTH} AND w[0] <> ''").select("item_id", F.size("w").alias("n"), F.array_join("w", " ").alias("run")).distinct()
    found = None
    for n in sorted(r["n"] for r in short.select("n").distinct().collect()):  # at most WIDTH - 1 lengths
        runs = F.arrays_zip(*[F.slice("w", i + 1, 1 << 30).alias(f"w{i}") if i else F.col("w").alias("w0") for i in range(n)])
        each = docs.select("doc_id", w.alias("w")).filter(F.size("w") >= n).select("doc_id", F.explode(runs).alias("r"))
        each = each.filter(F.col(f"r.w{n - 1}").isNotNull()).select("doc_id", F.concat_ws(" ", *[F.col(f"r.w{i}") for i in range(n)]).alias("run"))
        held = each.join(short.filter(F.col("n") == n).select("item_id", "run"), "run").select("doc_id", "item_id").distinct()
        found = held if found is None else found.unionByName(held)
    one = F.lit(1).cast("long")
    return None if found is None else found.select("doc_id", "item_id", one.alias("n_item"), one.alias("n_shared"), F.lit(1.0).alias("containment"))


def matches(docs: DataFrame, items: DataFrame, share: float = 0.8) -> DataFrame:
    """doc_id, item_id, n_item, n_shared, containment: items of which a document holds at least ``share``."""
    short = short_matches(docs, items)
    long_items = items.select("item_id", "text").filter(F.size(words(F.col("text"))) >= WIDTH)
    found = _long_matches(docs, long_items, share)
    return found if short is None else found.unionByName(short).groupBy("doc_id", "item_id").agg(
        F.max_by(F.struct("n_item", "n_shared", "containment"), F.struct("containment", "n_item")).alias("m")).select("doc_id", "item_id", "m.*")


def _long_matches(docs: DataFrame, items: DataFrame, share: float) -> DataFrame:
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("doc_key"))
    idx = index(items, share)
    hits = shingles(docs, "doc_id", "doc_key").join(idx, "hash").distinct()
    found = (hits.groupBy("doc_id", "doc_key", "item_id", "item_key").agg(F.count("*").alias("hits"), F.max("need").alias("need"))
             .filter("hits >= need")
             .select(F.col("doc_id").alias("d"), F.col("doc_key").alias("dk"), F.col("item_id").alias("i"), F.col("item_key").alias("ik")))
    held = docs.join(found, (F.col("dk") == F.col("doc_key")) & F.col("d").eqNullSafe(F.col("doc_id"))).select("doc_id", "doc_key", "i", "ik", "text")
    held = shingles(held.distinct(), "doc_id", "doc_key", "i", "ik", strings=True).distinct()
    wanted = shingles(items.select("item_id", F.xxhash64("text").alias("item_key"), "text").distinct(), "item_id", "item_key", strings=True).distinct()
    sizes = wanted.groupBy(F.col("item_id").alias("si"), F.col("item_key").alias("sk")).agg(F.count("*").alias("n_item"))
    shared = (held.join(wanted, (F.col("ik") == F.col("item_key")) & F.col("i").eqNullSafe(F.col("item_id")) & (held["shingle"] == wanted["shingle"]))
              .groupBy("doc_id", "doc_key", "item_id", "item_key").agg(F.count("*").alias("n_shared")))
    counted = shared.join(sizes, (F.col("item_key") == F.col("sk")) & F.col("item_id").eqNullSafe(F.col("si")))
    # Compare as whole numbers of thousandths: no rounding decides a match.
    return (counted.filter(F.col("n_shared") * 1000 >= F.col("n_item") * round(share * 1000))
            .withColumn("containment", F.col("n_shared") / F.col("n_item"))
            .groupBy("doc_id", "item_id").agg(F.max_by(F.struct("n_item", "n_shared", "containment"), F.struct("containment", "n_item")).alias("m"))
            .select("doc_id", "item_id", "m.*"))


def clean(docs: DataFrame, items: DataFrame, share: float = 0.8) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    name = common.free_name(docs, "_bad")
    bad = matches(docs, items, share).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col(name)), "left_anti")
