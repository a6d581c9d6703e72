"""Connected components of links, by alternating star steps over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.tables import kept_table

MAX_ROUNDS = 100


def _neighbour_minimum(links: DataFrame) -> DataFrame:
    """Each node of directed links ``a -> b`` with the smallest of itself and its neighbours."""
    return links.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))


def large_star(links: DataFrame) -> DataFrame:
    """Links of every node's larger neighbours to the smallest in its neighbourhood."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = _neighbour_minimum(both)
    moved = both.filter(F.col("b") > F.col("a")).join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.distinct()


def small_star(links: DataFrame) -> DataFrame:
    """Links of every node and its smaller neighbours to the smallest of them; ``a > b`` on the way in."""
    low = _neighbour_minimum(links)
    moved = links.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = low.select("a", F.col("m").alias("b"))
    return moved.unionByName(own).filter(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node it is linked to, for every node of links ``a``, ``b``.

    Every round makes links point to smaller nodes and never makes more of them; the
    rounds end when all links are stars around their smallest node. Each round's links are written to the shared
    folder, so a lost executor costs one round. A node with very many links is
    aggregated map-side, and its join is one adaptive execution can split.
    """
    now = kept_table(
        links.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    for _ in range(MAX_ROUNDS):
        now = kept_table(small_star(large_star(now)), "links")
        if _are_stars(now):
            nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
            roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return nodes.unionByName(roots)
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def _are_stars(links: DataFrame) -> bool:
    """Whether every node of links ``a > b`` has one link down, or only links from larger nodes."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        links.select(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    )
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return nodes.filter((F.col("down") > 1) | ((F.col("down") > 0) & (F.col("up") > 0))).count() == 0
