"""Connected components by alternating large and small stars, as DataFrame jobs.

Large star: every node links its larger neighbours to the smallest node it knows.  Small
star: every node links itself and its smaller neighbours to the smallest of them.  After
a number of rounds that grows with the logarithm of the longest path all nodes hang on
their component's smallest node.  A hub's neighbours are never gathered: each step is a
minimum (combined map-side) and a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges(a, b)`` with a > b in and out."""
    near = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        near = near.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = near.join(least, "u")
    if large:
        out = linked.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter("a > b").distinct()


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; the root is the smallest node of its component.

    The result is the table ``name`` of ``scratch``; a round's edges are deleted when the next are written.
    """
    edges = links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = scratch.table(edges, "edges")
    summary = None
    while True:
        edges = scratch.table(_star(_star(edges, True), False), "edges")
        # stable when every node has one edge, to a node without one: a sum over the edges is the same twice
        now = edges.agg(F.count(F.lit(1)), F.sum(F.col("b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == summary:
            break
        summary = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = scratch.table(roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()), name)
    scratch.drop("edges")
    return out
