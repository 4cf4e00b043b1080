"""Connected components of an edge table by alternating large-star and small-star steps.

All state is in tables: each round is two joins written to the scratch folder, nothing is
collected but a row count and a checksum.  A node with very many neighbours appears once per
neighbour, and its minimum is pre-aggregated before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import scratch_table

MAX_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``u, v`` (longs) -> ``node, root`` with the smallest node of the component as root.

    Nodes without an edge do not appear; loops and repeated edges are allowed.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()
    edges = scratch_table(edges, "cc")
    state = _state(edges)
    for _ in range(MAX_ROUNDS):
        # large star: every larger neighbour of a node points to the least node around it
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = scratch_table(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "cc")
        # small star: the smaller neighbours of a node point to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        edges = scratch_table(small, "cc")
        before, state = state, _state(edges)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root")))
