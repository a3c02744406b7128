"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.storage import kept


def _lowest(edges: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """The edges, stored, and the lowest neighbour of each u, itself included. Both are read as
    tables, so that Spark can split the rows of a u with very many neighbours."""
    edges = kept(edges.distinct(), name)
    return edges, kept(edges.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), f"{name}-low")


def components(edges: DataFrame) -> DataFrame:
    """(u, m) for every u that has an edge: m is the lowest node that its component holds.

    edges: columns u, v of one ordered type, not null, in either or both directions. No edges, no
    rows. Repeated edges and edges from a node to itself do no harm. The number of rounds grows with
    the logarithm of the longest path; each holds as many edges as the last, or fewer.
    """
    stars, before = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), None
    while True:
        both = stars.select("u", "v").union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        all_edges, low = _lowest(both, "large-star")
        large = all_edges.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = low.select("u", F.col("m").alias("v"))
        down, low = _lowest(large.union(own).filter("v <= u"), "small-star")
        small = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = kept(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "stars")
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return stars.groupBy("u").agg(F.min("v").alias("m"))
        before = now
