"""Connected components by minimum labels with pointer jumping; every round is a table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ladle.llm import common


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable over undirected ``edges`` (a, b). Nodes without an edge do not appear.

    Each round takes the smallest label among the neighbours, then follows labels of labels; rounds grow with the logarithm
    of the longest path. Labels of a node with very many neighbours are combined on the map side.
    """
    both = common.stage(edges.select("a", "b").union(edges.select("b", "a")).toDF("node", "other").distinct(), "edges")
    labels = common.stage(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node").agg(F.min("label").alias("near"))
        pulled = labels.join(near, "node").select("node", F.least("label", "near").alias("to"), F.col("label").alias("was"))
        jump = labels.select(F.col("node").alias("to"), F.col("label").alias("further"))
        after = common.stage(pulled.join(jump, "to", "left").select(
            "node", F.least("to", F.coalesce("further", "to")).alias("label"), "was"), "labels")
        changed = after.filter("label <> was").limit(1).count()
        labels = after.select("node", "label")
        if not changed:
            return labels
