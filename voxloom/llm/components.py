"""Connected components of a table of edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.session import cut_round


def components(edges: DataFrame) -> DataFrame:
    """id, component (its smallest id) for every id in edges a, b.

    Large star: every node joins its larger neighbours to the smallest node it knows. Small star: every
    node joins its smaller neighbours and itself to the smallest of them. Both are a minimum by key and a
    join, so a node with very many neighbours is split over tasks. Repeated until nothing changes.
    """
    edges = cut_round(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    while (now := _state(edges)) != state:
        state = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.unionByName(least.where("m < u").select("u", F.col("m").alias("v"))).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_round(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    digest = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(digest % (1 << 31)), F.lit(0)), F.bit_xor(digest)).first())
