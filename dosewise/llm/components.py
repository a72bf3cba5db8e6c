"""Connected components of an edge list, on Spark.

Alternating large-star and small-star rounds (Kiveris et al., 2014). Each
round is two aggregations with map-side combine and two equi-joins whose
right side has one row a node, so a node with very many neighbours is split
by AQE's skew join. Every round is written to the shared checkpoint folder;
only its number of rows and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum((F.xxhash64("u", "v") % 1_000_003).cast("long"))).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(u long, v long)`` -> ``(node long, root long)`` for every node
    that has an edge to another; root is the least node of its component.

    Loops, repeated and reversed edges and NULL ends are allowed (the last are
    ignored); an empty edge list gives an empty result.
    """
    e = edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    e = cut(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = _state(e)
    while before[0]:
        # large-star: every larger neighbour of u moves to the least of u's neighbourhood
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small-star: u and its smaller neighbours move to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        after = _state(e)
        if after == before:
            break
        before = after
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(stars.select("root", "root")).distinct()
