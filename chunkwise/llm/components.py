"""Connected components of a link table, all in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                           F.bit_xor(F.xxhash64("v", "u"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (first two columns, BIGINT): the smallest
    node that links lead to.  Large-star and small-star rounds: every node passes its
    smallest neighbour on to its neighbours, first to the larger ones, then to the smaller
    ones, until each component is a star around its smallest node.  Aggregates combine
    before their shuffles, and each round's links are stored."""
    a, b = (F.col(c).cast("long") for c in links.columns[:2])
    edges = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                   .filter("u > v").distinct(), "links")
    seen = _print(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"),
                                                             F.col("m").alias("v")).distinct()
        large = stored(large, "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = stored(small.select("u", F.col("m").alias("v"))
                       .unionByName(small.filter("v > m").select(F.col("v").alias("u"),
                                                                 F.col("m").alias("v")))
                       .distinct(), "links")
        now = _print(edges)
        if now == seen:
            break
        seen = now
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")))
            .distinct())
