"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle, tidied


def components(links: DataFrame) -> DataFrame:
    """``a, b`` -> ``id, component``: for each id that a link names, the least id reachable.

    Each step points the neighbours of a node at the least of them; it keeps as many edges as
    there are links at most and needs about log^2 of the longest path of steps. Minima are taken
    before the shuffle, and the join back can be split at a node of very many links. Null ends
    and links of an id with itself are left out; without links the result is empty.
    """
    return tidied(lambda: _components(links), links.sparkSession)


def _components(links: DataFrame) -> DataFrame:
    edges = settle(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = settle(large.where("a <> b"), "large")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("x"), F.col("m").alias("y")).unionByName(low.select(F.col("a").alias("x"), F.col("m").alias("y")))
        edges = settle(small.where("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    # Stars now: every node points at the least of its component.
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
