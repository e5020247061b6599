"""Connected components by alternating large-star and small-star rounds.

Hubs cost one row per neighbour: minima are aggregated map-side and joined back
by a shuffle join that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _star(pairs: DataFrame, both: bool) -> DataFrame:
    """Link each neighbour (large star: each larger one) of a node to the least of node and neighbours."""
    if both:
        near = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    out = near.join(least, "u")
    if both:
        out = out.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = out.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(scratch: Scratch, edges: DataFrame, prefix: str = "edges") -> DataFrame:
    """``node, component`` (the least node it reaches) for every node on an edge ``u, v``.

    ``prefix`` names the written tables; the last one stays until the caller drops it. Self loops, repeated and reversed edges are fine; an empty table gives an empty one.
    """
    edges = scratch.keep(edges.select("u", "v").where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{prefix}0")
    last, turn, name = None, 0, f"{prefix}0"
    while True:
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now == last or not now["n"]:
            break
        last, turn = now, turn + 1
        edges, old = scratch.keep(_star(_star(edges, True), False), f"{prefix}{turn}"), name
        scratch.drop(old)
        name = f"{prefix}{turn}"
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
