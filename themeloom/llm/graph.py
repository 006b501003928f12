"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from themeloom.plans.session import materialise


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them; edges have u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    down = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return down.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of `links(a, b)`; component is the smallest node reachable.

    Self links and repeated links are harmless, links with a null end are ignored, no links give no rows.
    Stars are written to the shared folder after every round, so a lost executor repeats one round at most.
    """
    edges = materialise(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    held = _state(edges)
    for _ in range(most_rounds):
        if not held[0]:
            break
        edges = materialise(_small_star(_large_star(edges)))
        now = _state(edges)
        if now == held:
            break
        held = now
    else:
        raise RuntimeError(f"components have not settled after {most_rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
