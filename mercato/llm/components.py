"""Connected components by alternating star contractions over written edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written


def _contract(edges: DataFrame, towards_all: bool) -> DataFrame:
    """Hang neighbours on the smallest one: all larger neighbours, or a node and its smaller ones."""
    if towards_all:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        return around.join(lowest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
    smaller = edges.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return smaller.unionByName(lowest.select("u", F.col("m").alias("v")))


def _signature(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1_000_003)).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has an edge (a, b); root is the component's smallest node.

    Alternates large-star and small-star steps until the edges no longer change, in a
    number of rounds logarithmic in the longest path. Each round is a written table.
    Hot nodes are minima (combined in the map tasks) and joins that adaptive execution splits.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = written(pairs, "links")
    last = None
    while (mark := _signature(now)) != last and mark[0]:
        last = mark
        step = _contract(now, True).filter("u <> v").distinct()
        now = written(_contract(step, False).filter("u <> v").distinct(), "links")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
