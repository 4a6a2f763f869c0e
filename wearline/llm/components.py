"""Connected components by alternating star contractions, wholly distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from wearline.llm.common import discard, land


def _landed(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, written, and their number and sum of hashes, which the writing job counts."""
    seen = Observation()
    counted = edges.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"))
    out = land(counted, "edges")
    return out, (seen.get["n"], seen.get["h"])


def _stars(edges: DataFrame, only_smaller: bool) -> DataFrame:
    """Hang the neighbours of every node (all larger ones, or all smaller ones) on its smallest."""
    arrows = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    if not only_smaller:
        arrows = arrows.unionByName(arrows.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = arrows.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    hung = arrows.join(least, "u")
    if only_smaller:
        own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        return hung.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(own).filter("a <> b").distinct()
    return hung.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component for every node of an edge (a, b): the smallest node that it reaches.

    Each step is written to the shared folder. Ends when a step changes nothing; the number of
    steps grows with the logarithm of the longest chain.
    """
    now, before = _landed(edges.filter("a <> b").select("a", "b").distinct())
    while before[0]:
        last = now
        now, size = _landed(_stars(_stars(last, False), True))
        discard(last)
        if size == before:
            break
        before = size
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component"))
    ).distinct()
