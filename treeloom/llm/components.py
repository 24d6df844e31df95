"""Connected components by alternating star contractions, on DataFrames alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeloom.session import stage


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node around it."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.union(least.select("u", F.col("m").alias("v"))).filter("u <> v")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node that has a link; root is the smallest node it reaches.

    Each round at least halves the longest way to a root. Its edges, never more than the
    links, are written to the shared folder, so a lost executor repeats one round at most.
    Minima are reduced per task, so a node with very many links stays one row per task.
    Links with a null end and links of a node to itself are left out.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = stage(edges.filter(f"`{a}` <> `{b}`").distinct(), "links")
    before, now = None, _signature(edges)
    while now != before and now[0]:
        edges = stage(_small_star(_large_star(edges).distinct()).distinct(), "links")
        before, now = now, _signature(edges)
    rooted = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return rooted.union(edges.select("v", "v").distinct())
