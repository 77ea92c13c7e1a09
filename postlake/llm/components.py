"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, materialise


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.select(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def star_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """From undirected edges (``u``, ``v``) to rows (``u``, ``v``): each node but
    the smallest of its component, with that smallest node.

    Each round hangs every larger neighbour, then every smaller one, on the
    smallest in sight; rounds grow with the logarithm of the longest chain.
    Each is written to the shared folder. No component meets in one task: a
    hub's neighbours are joined to its minimum, which is pre-aggregated.
    """
    spark = edges.sparkSession
    old: list[str] = []
    tidy = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = materialise(tidy, "edges", old)
    seen = _signature(now)
    for _ in range(most_rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new: list[str] = []
        now = materialise(rest.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges", new)
        drop(spark, old)
        old = new
        if (sign := _signature(now)) == seen:
            return now
        seen = sign
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
