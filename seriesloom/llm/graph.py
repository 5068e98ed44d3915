"""Connected components by alternating large-star and small-star steps, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import write_table


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: hang the larger (``large``) or the not larger neighbours of every node on its smallest one."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    near = both.join(least, "u")
    if large:
        out = near.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = near.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = out.union(least.select("u", F.col("m").alias("v")))
    return out.filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (u, v); the root is the smallest node of its component.

    Each round writes its edges to the shared folder; the edges never exceed the
    number of links.  Ends when a round changes nothing, after a number of rounds
    that grows with the logarithm of the longest chain.
    """
    edges = edges.select("u", "v").filter(F.col("u") != F.col("v"))
    seen = None
    while True:
        edges = write_table(_star(_star(edges, True), False), "components")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
