"""Connected components by alternating large and small stars, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from meterlake.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """`id, component` for every id in `links(a, b)`: the smallest id that can be reached.

    Each round links ids to the smallest neighbour and is written to the shared folder. Rounds
    needed grow with the logarithm of the longest chain. Minima combine before the shuffle and
    joins on a hot id are split by adaptive execution. Links from an id to itself are allowed
    and give that id alone.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    before = None
    while (now := state(edges)) != before:
        before = now
        edges = stored(small_star(large_star(edges)), "links")
    return (
        edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
        .union(edges.select("b", "b"))
        .distinct()
    )


def state(edges: DataFrame) -> tuple:
    """Count and order-free checksum of the links."""
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), total).first())


def large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of each id to its smallest neighbour."""
    both = edges.union(edges.select("b", "a")).select(F.col("a").alias("id"), F.col("b").alias("to"))
    smallest = both.groupBy("id").agg(F.least(F.min("to"), "id").alias("m"))
    linked = both.join(smallest, "id").where("to > id").select(
        F.col("to").alias("a"), F.col("m").alias("b")
    )
    # An id linked only to itself stays.
    return linked.union(edges.where("a = b")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Link the smaller neighbours of each id, and the id, to the smallest of them."""
    smallest = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(smallest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(smallest.select("a", F.col("m").alias("b"))).distinct()
