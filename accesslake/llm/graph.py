"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslake.llm.common import materialize

MAX_ROUNDS = 64


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    least = _least(edges)
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).distinct()


def components(edges: DataFrame, name: str = "stars") -> DataFrame:
    """(node, component) of every node of `edges` (u, v): the least node it reaches.

    Self-loops, repeated edges and edges with a null end are ignored. Each
    round is written to the shared folder, so a lost executor repeats one round
    at most. Only a count and a checksum come to the driver.
    """
    now = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    seen = None
    for _ in range(MAX_ROUNDS):
        now = materialize(now if seen is None else small_star(large_star(now)), name)
        mark = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if mark == seen or mark[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = mark
    raise RuntimeError("components did not settle")
