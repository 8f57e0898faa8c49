"""Connected components of a list of links, as rounds of joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import written
from ledgerloom.operators.skew import lookup


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); ``root`` is the smallest node of its component.

    Each round points every node at its smallest neighbour, follows the pointers twice, and contracts
    the links between the nodes that remain. A path of length n is done in about log2(n) rounds; a
    star in one. Nothing but the number of links left reaches the driver.
    """
    edges = links.where("a <> b").select("a", "b")
    labels = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
        parent = written(least.select("node", F.least("node", "near").alias("root")), "parents")
        for _ in range(2):
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("next"))
            parent = lookup(parent, up, ["root"], "left").select("node", F.coalesce("next", "root").alias("root"))
        parent = written(parent, "roots")
        if labels is None:
            labels = parent
        else:
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("next"))
            labels = written(lookup(labels, up, ["root"], "left").select("node", F.coalesce("next", "root").alias("root")), "labels")
        edges = (lookup(edges, parent.withColumnsRenamed({"node": "a", "root": "ra"}), ["a"], "left"))
        edges = lookup(edges, parent.withColumnsRenamed({"node": "b", "root": "rb"}), ["b"], "left")
        edges = written(edges.where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            return labels
