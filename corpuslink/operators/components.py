"""Connected components of a graph by stars, in rounds that are written out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scale import materialize


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """The smallest node of its component for every node that has an edge.

    `edges` has two columns of one ordered type; direction, repeats and loops do not
    matter, edges with null are left out. Returns node and component. Each round
    links all neighbours of a node to the smallest of them, first the larger
    neighbours, then the smaller ones, until nothing changes; the number of rounds
    grows with the logarithm of the longest path. The smallest neighbours are written
    before they are joined, so that a node with very many edges can be split over
    tasks. No edges give no rows.
    """
    a, b = edges.columns
    edges = materialize(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                        .where("u > v").distinct())
    before = None
    while (state := _state(edges)) != before:
        before = state
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")))
        large = materialize(both.join(least, "u").where("v > u")
                            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
            F.col("m").alias("v"))
        # A node linked to more than its smallest neighbour keeps that link as well.
        edges = materialize(small.union(least.select("u", F.col("m").alias("v"))).distinct())
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
