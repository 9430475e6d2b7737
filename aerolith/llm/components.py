"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.session import materialize


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """One star step. ``large``: every node links its larger neighbours to its
    smallest one; else its smaller neighbours, and itself. The smallest
    neighbours are pre-aggregated minima, written before they are joined, so the
    join has a shuffle on either side that AQE can split for a hub."""
    lowest = pairs.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    lowest = materialize(lowest, "lowest")
    spread = pairs.join(lowest, "u")
    if large:
        return spread.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v"))
    below = spread.where(F.col("v") < F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v"))
    own = lowest.where(F.col("low") < F.col("u")).select("u", F.col("low").alias("v"))
    return below.unionByName(own)


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def component_roots(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (longs ``u, v``) that is not
    its component's smallest node: alternating large and small stars until the
    table stops changing. Each round is written, so a lost executor repeats one
    round at most; no links reach the driver."""
    edges = materialize(edges.where(F.col("u") != F.col("v")).select("u", "v").distinct(), "links")
    before = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before or not state["n"]:
            break
        before = state
        larger = _star(_both_ways(edges), large=True).where(F.col("u") != F.col("v")).distinct()
        # Small stars look from each node down, which is how large stars leave the pairs.
        edges = materialize(_star(larger, large=False).where(F.col("u") != F.col("v")).distinct(), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
