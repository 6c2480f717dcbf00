"""Connected components by alternating large-star and small-star rounds.

Each round links every node to the smallest of its neighbours, once for its
larger and once for its smaller neighbours, until the edges are stars around
the smallest node of each component. Rounds are written as tables, so lineage
stays short; only a count and a checksum reach the driver."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch


def _oriented(edges: DataFrame) -> DataFrame:
    return (edges.where("a != b")
            .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())


def _star(edges: DataFrame, neighbours: DataFrame) -> DataFrame:
    """Neighbours ``(u, v)`` as edges to the smallest node that ``u`` sees."""
    least = neighbours.groupBy("u").agg(F.min("v").alias("m"))
    return neighbours.join(least, "u").select("u", "v", F.least("m", "u").alias("m"))


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, component`` (the smallest node of the component) for every node
    of ``edges`` (columns ``a``, ``b``) that has an edge to another node."""
    now = scratch.table(_oriented(edges))
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                now.select("v", "v").distinct())
        before = state
        both = now.union(now.select("v", "u"))
        large = _oriented(_star(now, both).where("v > u").select(F.col("v").alias("a"),
                                                                 F.col("m").alias("b")))
        small = _star(large, large)
        after = scratch.table(_oriented(small.select(F.explode(F.array(
            F.struct(F.col("u").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("v").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")))
        scratch.drop(now)
        now = after
