"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperfield.session import materialize


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of each node to the smallest of them: the larger ones, or the smaller ones and the node."""
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    linked = both.join(least, "a")
    if large:
        moved = linked.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return moved.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): each node of ``edges`` (a, b) with the smallest node it reaches.

    Large-star and small-star steps alternate until every edge points at a smallest node; each step shuffles edges
    only, writes them to the shared folder and needs a number of rounds that grows with the logarithm of the nodes.
    Rows with a null end are left out.
    """
    edges = materialize(edges.select("a", "b").filter("a <> b"), "edges")  # each step reads its edges more than once
    known = None
    while True:
        edges = materialize(_stars(_stars(edges, True), False), "stars")
        state = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("decimal(38,0)"))).first()
        if state == known:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        known = state
