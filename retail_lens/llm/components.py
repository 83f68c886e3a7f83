"""Connected components of a graph given as edges, by alternating large-star and small-star steps.

Each step hooks a node's neighbours to its smallest neighbour; after a number of rounds
that grows with the logarithm of the longest path every node hangs on the smallest node of
its component. Edges are staged between rounds, so a lost executor costs one step; nothing
but two figures a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retail_lens.llm.common import join_spread
from retail_lens.session import Staging


def _hooked(pairs: DataFrame, stage: Staging) -> DataFrame:
    """Each row (u, v) with the smallest of u and all its v. A node of very many rows is no hot task."""
    pairs = stage(pairs, "pairs")
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("rows"))
    return join_spread(pairs, stage(least, "least"), "u", "rows")


def components(edges: DataFrame, stage: Staging) -> DataFrame:
    """One row per node that is in an edge: node, component (the smallest node reachable).

    ``edges`` has two columns of longs, in any order, direction and number of repeats; loops
    and edges with a null count for nothing.
    """
    a, b = edges.columns
    found = edges.select(F.least(a, b).alias("v"), F.greatest(a, b).alias("u")).filter(f"`{a}` <> `{b}`")
    found = stage(found.distinct(), "edges")
    before = None
    while True:
        both = found.select("u", "v").unionByName(found.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _hooked(both, stage).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _hooked(large.filter("u <> v").distinct(), stage)  # here v < u
        small = small.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        found = stage(small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).filter("u <> v").distinct(), "edges")
        now = found.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            break
        before = now
    hung = found.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return hung.unionByName(hung.select(F.col("component").alias("node"), "component").distinct())
