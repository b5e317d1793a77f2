"""Connected components of a table of links, in a few rounds of joins."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from harborline.llm.common import stage

# A link is two numbers, so a file of this many is a few MB.
LINKS_IN_FILE = 1 << 18


def _starred(edges: DataFrame) -> DataFrame:
    """One large and one small star; u is the larger end of a link, before and after."""
    up = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    least = edges.union(up).groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    large = up.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.union(least.select("u", "m")).where("u <> v").distinct()


def _done(edges: DataFrame) -> bool:
    """Whether every node has one link and none of them leads to a node that has a link itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
    each = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return each.where("out > 1 OR (out > 0 AND into > 0)").isEmpty()


def connected(links: DataFrame, a: str, b: str) -> DataFrame:
    """node and root (the smallest node of its component) for every node that has a link, but for the roots themselves.

    Large and small stars in turn: each node points its larger neighbours, then itself and its smaller neighbours, at
    the smallest one it knows. The rounds grow with the logarithm of the longest path. Each one is written, so plans and
    lineage stay short (a round names its links nine times, two in one plan would name them 81 times), and minima are
    taken before the shuffle, so a node of very many links is no burden to one task.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = stage(edges, "links")
    # A star never makes more links than it gets, so the first table says how many files are enough.
    files = max(1, math.ceil(edges.count() / LINKS_IN_FILE))
    while not _done(edges):
        edges = stage(_starred(edges).coalesce(files), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
