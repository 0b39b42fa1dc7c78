"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewater.session import settle


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _starred(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Point the neighbours of every node at the smallest of them.

    Large star: all neighbours count and those above the node move. Small star: only the
    neighbours below count, and they and the node itself move.
    """
    around = edges.select("u", "v")
    if both_ways:
        around = around.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = around.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    moved = around.join(least, "u")
    if both_ways:
        moved = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.where("u != v").distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """``node, component`` of all nodes that occur in the integer links ``u, v``.

    The component is its smallest node. Loops and repeated links do no harm; an empty
    table gives an empty one. Every round is written to the shared folder, which cuts the
    lineage; the number of rounds grows with the logarithm of the longest chain, and no
    node's neighbours are ever gathered in one row, so hot nodes are joins that
    adaptive execution can split.
    """
    edges = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = settle(edges, name)
    before = _state(edges)
    while True:
        edges = settle(_starred(_starred(edges, True), False), name)
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
