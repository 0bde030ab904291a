"""Connected components by alternating large-star and small-star steps.

Each step gives every node's neighbours the smallest node among them; minima are combined before the shuffle
and joined back, so a node with very many neighbours never meets them in one task (Spark splits the large
side of the join). Steps are stored, which cuts the lineage and survives lost executors; in as many files as their rows
call for, however many shuffle partitions there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.workspace import materialize


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One step over (a, b) with a > b."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if larger:
        both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("least")).withColumn("least", F.least("u", "least"))
    joined = both.join(least, "u")
    moved = joined.where("v > u") if larger else joined.where("v <> least")
    out = moved.select(F.col("v").alias("a"), F.col("least").alias("b"))
    if not larger:
        out = out.unionByName(least.select(F.col("u").alias("a"), F.col("least").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, most: int | None = None) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b), both long; the component is its smallest node.

    ``most``, where it is known, is a number of rows that ``edges`` does not exceed.
    """
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state = materialize(ordered, "edges", most)
    seen = None
    while True:
        figures = state.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if (figures["n"], figures["x"]) == seen or not figures["n"]:
            break
        seen = (figures["n"], figures["x"])
        large = materialize(_star(state, True), "large", figures["n"])  # no step adds edges
        state = materialize(_star(large, False), "small", figures["n"])
    roots = state.select(F.col("b").alias("node")).distinct()
    return state.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.withColumn("component", F.col("node"))
    )
