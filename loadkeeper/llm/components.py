"""Distributed union-find: connected components from links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadkeeper.llm.shared import cut


def _stars(edges: DataFrame) -> DataFrame:
    """(x, least): the smallest node among x and its neighbours, for edges(x, y); summed before it is shuffled."""
    return cut(edges.groupBy("x").agg(F.min(F.least("x", "y")).alias("least")))


def _joined(edges: DataFrame, stars: DataFrame) -> DataFrame:
    """The edges with the least of x. Both sides are plain shuffles, so a hub's edges are split over tasks."""
    return edges.join(stars, "x")


def components(links: DataFrame) -> DataFrame:
    """(node, root): every node of links(a, b), two longs, with the smallest node it can reach.

    Large stars point every larger neighbour of a node to the node's least one, small stars every
    smaller neighbour and the node itself; repeated, the edges end as one star for each component,
    after a number of rounds that grows with the logarithm of the longest path. A round is two
    joins of the edges with one row per node; edges stay in the shared folder between rounds.
    Links with a null end, and links of a node to itself, link nothing and give no row.
    """
    edges = links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    edges = cut(edges.select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).distinct())
    sign = None
    while sign != (sign := edges.agg(F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first()):
        both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        large = _joined(both, _stars(both)).filter("y > x AND y <> least").select(F.col("y").alias("x"), F.col("least").alias("y"))
        large = cut(large.distinct())
        small = _joined(large, _stars(large))
        low = small.filter("y <> least").select(F.col("y").alias("x"), F.col("least").alias("y"))
        edges = cut(low.unionByName(small.filter("x <> least").select("x", F.col("least").alias("y"))).distinct())
    roots = edges.select(F.col("x").alias("node"), F.col("y").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
