"""Connected components of links between long ids, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.operators.skew import join_counted
from starmill.session import materialise


def _sum(edges: DataFrame) -> tuple:
    """Number of edges and a sum over their hashes, to see whether a round changed any."""
    mixed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mixed)).first())


def _least(edges: DataFrame, label: str) -> DataFrame:
    """Per `a` the least of itself and its `b`, and its number of edges; combined before the shuffle."""
    least = edges.groupBy("a").agg(F.least("a", F.min("b")).alias("least"), F.count(F.lit(1)).alias("edges"))
    return materialise(least, label)


def components(links: DataFrame) -> DataFrame:
    """`node` and `root` (the least id it is linked with over any number of steps), for linked nodes.

    `links` has long columns `a` and `b`, in any order, repeats and self-links allowed; nulls are
    left out. Rounds of star contraction: every node's larger neighbours, then its smaller ones,
    are handed to the least neighbour. The number of rounds grows with the logarithm of the
    largest component; each round is written, so a lost executor costs a re-read. A node with very
    many links is met by broadcast, see `join_counted`.
    """
    swapped = F.struct(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = links.where("a <> b").select(swapped.alias("e")).select("e.*").distinct()
    edges = materialise(edges, "edges")
    before = _sum(edges)
    while before[0]:
        both = materialise(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges-both")
        met = join_counted(both, _least(both, "least"), ["a"], "edges")
        large = met.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()
        large = materialise(large, "edges-large")
        met = join_counted(large, _least(large, "least"), ["a"], "edges")
        small = met.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(
            met.select("a", F.col("least").alias("b"))
        )
        edges = materialise(small.where("a <> b").distinct(), "edges")
        after = _sum(edges)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
