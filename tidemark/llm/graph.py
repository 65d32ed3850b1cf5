"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest one."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = written(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "star")
    return (both.join(low, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = written(down.groupBy("u").agg(F.min("v").alias("m")), "star")
    return (down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, component`` (smallest node reachable) of every node of ``edges``
    (columns ``u, v`` of one orderable type).  Rows with a null end and loops
    tie nothing; a node only in such rows has no row.  Repeated edges count
    once.  The neighbours of a node are only aggregated or joined, never
    gathered; the smallest neighbours are written before they are joined, so that
    the join is split at a hub, and each round is a written table."""
    now = written(edges.select("u", "v").where("u <> v").distinct(), name)
    state = _state(now)
    while state[0]:
        now = written(_small_star(_large_star(now)), name)
        before, state = state, _state(now)
        if state == before:
            break
    return (now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
