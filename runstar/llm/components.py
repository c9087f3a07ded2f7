"""Connected components of a written table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runstar.sources.workspace import Workspace


def _smallest(links: DataFrame) -> DataFrame:
    """(u, least): the smaller of a node and its smallest neighbour."""
    return links.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))


def components(links: DataFrame, work: Workspace, name: str = "stars") -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); a component is named after its smallest node.

    Each round is a written table, so a lost executor costs one round at most. A hub's neighbours are never gathered:
    only their minimum is, which map tasks combine, and the join back is one that adaptive execution can split.
    """
    links = work.keep(f"{name}-0", links.where("a != b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    k, before = 0, None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_smallest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        large = work.keep(f"{name}-{k}-large", large.where("u != v").distinct())
        # small star: a node's smaller neighbours, and itself, move to the smallest of them
        least = _smallest(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        small = small.unionByName(least.select("u", F.col("least").alias("v")))
        k += 1
        links = work.keep(f"{name}-{k}", small.where("u != v").distinct())
        state = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before = state
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).distinct()
