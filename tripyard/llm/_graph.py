"""Connected components of a large edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripyard.llm._tables import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); nulls are not nodes.

    Contraction: in each round every node joins the smallest node of its
    neighbourhood (and that node's own choice), and edges move to the joined
    nodes. Rounds grow with the logarithm of the nodes; each round's tables are
    written, and nothing is collected.
    """
    left = staged(edges.select("a", "b").where("a <> b").distinct(), "graph-edges")
    labels = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        chosen = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("to"))
        chosen = staged(chosen, "graph-choices")
        next_of = chosen.select(F.col("node").alias("to"), F.col("to").alias("far"))
        chosen = staged(chosen.join(next_of, "to").select("node", F.col("far").alias("to")), "graph-joined")
        moved = chosen.select(F.col("node").alias("component"), F.col("to").alias("moved"))
        labels = chosen.withColumnRenamed("to", "component") if labels is None else labels.join(moved, "component", "left").select(
            "node", F.coalesce("moved", "component").alias("component"))
        labels = staged(labels, "graph-labels")
        at = lambda c: chosen.select(F.col("node").alias(c), F.col("to").alias(f"{c}_to"))
        left = staged(left.join(at("a"), "a").join(at("b"), "b").select(
            F.col("a_to").alias("a"), F.col("b_to").alias("b")).where("a <> b").distinct(), "graph-edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
    return labels
