"""Connected components of an edge table in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.session import materialize


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).head())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of ``edges`` (a, b): the smallest node reachable.

    Large-star and small-star rounds in turn: each replaces edges by edges to a smaller neighbour, so
    the number of edges does not grow and long chains shrink fast. A hub's neighbours are only
    aggregated, never gathered. Every round is a table in the shared folder.
    """
    links = materialize(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "links"
    )
    state = _state(links)
    while True:
        both = links.union(links.select("b", "a")).toDF("v", "u")
        least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        large = both.where("u > v").join(least, "v").select(F.col("u").alias("a"), F.col("m").alias("b")).distinct()
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        after = materialize(small.select("e.*").where("a > b").distinct(), "links")
        links, before, state = after, state, _state(after)
        if state == before:
            break
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
