"""Prefix trie over conversations, built by van Emde Boas recursion on its depth.

The trie of height 2**k is cut at half depth: an upper trie of height 2**(k-1), and below each of its bottom nodes, the cut
prefixes, a lower forest of the same height. Upper and lower parts are tries of half the height and are cut again. The
recursion is run level by level, all blocks of one height at once, so every level is one Spark job over all of them:

* *Naming.* A node is named by a digest. In blocks of height 1 it is that of the turn. Two parts of height h make a block of
  height 2h: names of the upper part stay, a node of the lower part takes the digest of (name of its cut prefix, own name).
  After log2(depth) levels every name stands for a whole prefix. A row takes part only in levels that change its name.
* *Grafting.* Totals start as each node's own values. Two parts of height h are joined by summing the totals of the lower
  part's roots for each cut prefix, and adding that to the prefix and its ancestors within the upper part.

A conversation is one key of these jobs only together with its block, and the larger side of each join holds the rows, so a
conversation with very many turns, or a prefix that very many conversations share, is split like any skewed join. Names have 128
bits; among 10**12 prefixes two different ones share a name with probability below 1e-14.

Defined cases: rows without a conversation id are left out; null roles and texts are empty; turns with equal numbers are ordered by
role and text, null numbers come first; repeated rows are repeated turns; extra columns are ignored; an empty table has no node.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ladle.llm import common
from ladle.operators.ordered import row_numbers

#: A conversation takes at most this many turns, less one, of another; texts are cut to prefixes where only ranges are chosen.
LENDS, PREFIX = 9, 48


def _digest(*parts: Column) -> Column:
    return F.substring(F.unhex(F.sha2(F.concat(*parts), 256)), 1, 16)


def turns(rows: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), turn (digest of role and text), bytes of the text: the turns of each conversation in order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    plain = rows.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("number"), role.alias("role"), text.alias("text"),
        F.octet_length(text).cast("long").alias("bytes"),
        _digest(F.octet_length(role).cast("string").cast("binary"), F.lit(":").cast("binary"), role.cast("binary"), text.cast("binary")).alias("turn"))
    return row_numbers(plain, "conv_id", [F.col("number"), F.col("role"), F.col("text")], "pos",
                       [F.col("number"), F.substring("role", 1, PREFIX), F.substring("text", 1, PREFIX)], ["conv_id", "turn", "bytes"])


def lend(own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like others: c takes the first h turns of c - c % 5, then its own after its first h.

    h is crc32 of the decimal c, modulo ``LENDS``. Returns the turns, and (conv_id, n) of all conversations, turnless ones too.
    """
    sizes = common.stage(own.groupBy("conv_id").agg(F.max("pos").alias("size")).withColumns({
        "h": (F.crc32(F.col("conv_id").cast("string")) % LENDS).cast("long"), "lender": F.col("conv_id") - F.col("conv_id") % 5}), "sizes")
    lent = F.least("h", F.coalesce("lender_size", F.lit(0)))
    convs = common.stage(sizes.join(sizes.select(F.col("conv_id").alias("lender"), F.col("size").alias("lender_size")), "lender", "left").select(
        "conv_id", "lender", "h", lent.alias("lent"), (lent + F.greatest(F.col("size") - F.col("h"), F.lit(0))).alias("n")), "lent")
    heads = own.filter(F.col("pos") < LENDS).withColumnRenamed("conv_id", "lender").join(convs, "lender").filter("pos <= h").select(
        "conv_id", "pos", "turn", "bytes", (F.col("pos") == F.col("n")).alias("last"))
    tails = own.join(convs, "conv_id").filter("pos > h").withColumn("pos", F.col("pos") - F.col("h") + F.col("lent")).select(
        "conv_id", "pos", "turn", "bytes", (F.col("pos") == F.col("n")).alias("last"))
    return heads.unionByName(tails), convs.select("conv_id", "n")


def _block(pos: Column, level: int) -> Column:
    """Number of the block of height 2**level that a depth lies in; even ones are upper parts of the next level."""
    return F.shiftright(pos - 1, level)


def named(sequences: DataFrame) -> tuple[DataFrame, int]:
    """The turns with ``name`` of the prefix that ends there, and the number of levels of the recursion."""
    open_ = common.stage(sequences.withColumnRenamed("turn", "name"), "turns")
    depth = open_.agg(F.max("pos")).first()[0] or 0
    closed, level = [], 0
    while 1 << level < depth:
        height = 1 << level
        lower = _block(F.col("pos"), level) % 2 == 1
        prefix = open_.filter(F.col("pos") % (2 * height) == height).select("conv_id", F.col("pos").alias("_cut"), F.col("name").alias("_prefix"))
        below = open_.filter(lower).withColumn("_cut", F.shiftleft(_block(F.col("pos"), level), level)).join(prefix, ["conv_id", "_cut"])
        below = below.withColumn("name", _digest(F.col("_prefix"), F.col("name"))).select(*open_.columns)
        renamed = common.stage(open_.filter(~lower).unionByName(below), "named")
        # No later level changes a name above depth 2 * height, or asks for one.
        closed.append(renamed.filter(F.col("pos") < 2 * height))
        open_ = renamed.filter(F.col("pos") >= 2 * height)
        level += 1
    return reduce(DataFrame.unionByName, [*closed, open_]), level


def nodes(sequences: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows, levels = named(sequences)
    rows = common.stage(rows, "prefixes")
    distinct = common.stage(rows.groupBy(F.col("pos").alias("depth"), "name").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes")), "distinct")
    smallest, all_convs = convs.agg(F.min("conv_id"), F.count("*")).first()

    # A node is known by its depth and smallest member from here on; its parent is on that member's own path.
    above = rows.select("conv_id", (F.col("pos") + 1).alias("depth"), F.col("name").alias("parent_name"))
    parents = distinct.select((F.col("depth") + 1).alias("depth"), F.col("name").alias("parent_name"), F.col("conv_id").alias("parent"))
    linked = distinct.filter("depth > 1").join(above, ["conv_id", "depth"]).join(parents, ["depth", "parent_name"]).drop("parent_name")
    linked = linked.unionByName(distinct.filter("depth = 1").withColumn("parent", F.lit(smallest).cast("long")).select(*linked.columns))
    children = linked.groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("conv_id")).agg(F.count("*").alias("n_children"))
    tree = common.stage(linked.join(children, ["depth", "conv_id"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))).select(
        "depth", "conv_id", "parent", "name", "n_convs", "n_children",
        (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved")), "tree")
    paths = common.stage(rows.join(tree.select(F.col("depth").alias("pos"), "name", F.col("conv_id").alias("top"), "parent"), ["pos", "name"]).select(
        F.col("conv_id").alias("member"), "pos", "top", "parent", "last"), "paths")

    totals = graft(tree.select("depth", "conv_id", "parent", "leaves", "saved"), paths, levels)
    sums = totals.groupBy("depth", "conv_id").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    ends = paths.filter("last").select(F.col("pos").alias("depth"), F.col("top").alias("conv_id"), "member").unionByName(
        convs.filter("n = 0").select(F.lit(0).cast("long").alias("depth"), F.lit(smallest).cast("long").alias("conv_id"), F.col("conv_id").alias("member")))
    ends = common.ordered_digest(ends.withColumn("said", F.col("member").cast("string")), ["depth", "conv_id"], ["member"], "said", ",")
    whole = common.stage(tree.join(sums, ["depth", "conv_id"]).select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens"), "nodes")
    below = whole.filter("depth = 1").agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    first = below.filter(F.lit(all_convs > 0)).select(
        F.lit(smallest).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), F.lit(all_convs).cast("long").alias("n_convs"), "n_children",
        F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"), F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"))
    return whole.unionByName(first).join(ends, ["depth", "conv_id"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def graft(own: DataFrame, paths: DataFrame, levels: int) -> DataFrame:
    """Parts of each node's totals over its subtree, from ``own`` (depth, conv_id, parent, leaves, saved); they are to be summed.

    ``paths`` has each conversation's nodes (member, pos, top, parent). Sums are linear, so totals stay a list of parts.
    """
    parts = own
    for level in range(levels):
        height = 1 << level
        roots = parts.filter(F.col("depth") % (2 * height) == (height + 1) % (2 * height)).groupBy(F.col("parent").alias("member"), (F.col("depth") - 1).alias("cut")).agg(
            F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        roots = roots.withColumn("_part", _block(F.col("cut"), level))
        upper = paths.filter(_block(F.col("pos"), level) % 2 == 0).withColumn("_part", _block(F.col("pos"), level))
        grown = upper.join(roots, ["member", "_part"]).groupBy(F.col("pos").alias("depth"), F.col("top").alias("conv_id"), "parent").agg(
            F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        parts = parts.unionByName(common.stage(grown.select(*own.columns), "grafts"))
    return parts
