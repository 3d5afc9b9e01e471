"""Connected components of a graph given as a table of links, by contraction.

A round sends every node to a neighbour (or itself) and draws the links anew between what the nodes were sent to: links within one
place vanish and equal ones fall together, so that each round joins fewer rows than the one before. The first round goes by
the ids, as the links given are mostly stars around the smallest one; later ones by hashes that change with the round, which
halve even a long path in expectation. Rounds are joins of written tables, so that adaptive execution can split a hot node,
and partial aggregations. Nothing but a count a round comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import materialize

MAX_ROUNDS = 60


def _once(links: DataFrame) -> DataFrame:
    """Each link between different nodes once, the smaller one first."""
    return links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """links: a, b. Result: node, component (the smallest node that can be reached), a row per node of the links."""
    edges, labels = materialize(_once(links), "edges"), None
    for k in range(MAX_ROUNDS):

        def ranked(node: str, k: int = k) -> Column:
            return F.struct((F.xxhash64(node, F.lit(k)) if k else F.col(node)).alias("rank"), F.col(node).alias("node"))

        ends = edges.select(F.col("a").alias("node"), F.col("b").alias("_other")).union(edges.select("b", "a"))
        first = ends.groupBy("node").agg(F.min(ranked("_other")).alias("_first"))
        sent = materialize(first.select("node", F.least("_first", ranked("node"))["node"].alias("place")), "sent")
        one, other = sent.select(F.col("node").alias("a"), F.col("place").alias("_a")), sent.select(F.col("node").alias("b"), F.col("place").alias("_b"))
        edges = materialize(_once(edges.join(one, "a").join(other, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))), "edges")
        if k:
            moved = labels.join(sent.select(F.col("node").alias("place"), F.col("place").alias("_to")), "place", "left")
            labels = materialize(moved.select("node", F.coalesce("_to", "place").alias("place")), "labels")
        else:
            labels = sent
        if not edges.limit(1).count():
            smallest = labels.groupBy("place").agg(F.min("node").alias("component"))
            # What went by ids alone is at its smallest node.
            return materialize(labels.join(smallest, "place").select("node", "component"), "labels") if k else labels.withColumnRenamed("place", "component")
    raise RuntimeError(f"components didn't settle in {MAX_ROUNDS} rounds")
