"""Connected components of an undirected graph, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from sluice.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) -> (id, component): the smallest id that each id reaches.

    A large-star step links every greater neighbour of a node to the smallest node of its neighbourhood, a
    small-star step every smaller one; the edges end as stars around the smallest ids.  Each step is a minimum
    with partial aggregation and a join on the node, and is written, so lineage stays short.
    """
    def step(links: DataFrame, large: bool, label: str) -> tuple[DataFrame, tuple]:
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            both = both.union(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        near = both.join(least, "u")
        if large:
            out = near.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = near.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        seen = Observation()
        out = written(out.where("a <> b").distinct().observe(
            seen, F.count(F.lit(1)).alias("n"), F.sum(F.hash("a", "b").cast("long")).alias("h")), label)
        return out, (seen.get["n"], seen.get["h"])

    # Every edge from its greater to its smaller end.
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    before = None
    while True:
        links, _ = step(links, True, "large-star")
        links, now = step(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), False, "small-star")
        if now == before:
            break
        before = now
    # Stars now: every node but the smallest points at the smallest.
    own = links.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("id"), "component")
    return own.unionByName(links.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
