"""Connected components of links between long ids, as Spark joins.

Alternating star contraction: the large star ties every larger neighbour of a node to the
smallest of its neighbourhood, the small star does so with the smaller neighbours, until only
stars around each component's smallest node are left, after a logarithmic number of rounds.
Each step's minima and links are written to the shared scratch folder: lineage stays
flat, and both sides of each join are exchanges, so AQE can split a node with many links.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fulcrum.llm.scratch import Scratch

#: Links per written file: a step over few links is a few tasks, whatever the session's
#: number of shuffle partitions.
LINKS_PER_FILE = 500_000


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the component's smallest node."""
    files = max(1, ceil(links.count() / LINKS_PER_FILE))
    edges = scratch.write(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().coalesce(files), "links")
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, scratch, F.col("v") > F.col("u"), False, files)
        small = _star(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), scratch, F.lit(True), True, files)
        scratch.remove(edges)
        edges, before = small, mark
        mark = _mark(edges)
        if mark == before:
            break
    roots = edges.select(F.col("v").alias("node")).distinct()
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(roots.select("node", F.col("node").alias("root"))))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def _star(edges: DataFrame, scratch: Scratch, taken: Column, own: bool, files: int) -> DataFrame:
    """Tie the ``taken`` neighbours of each node (and, if ``own``, itself) to the smallest."""
    least = scratch.write(
        edges.groupBy(F.col("u").alias("_u")).agg(F.least(F.min("v"), F.col("_u")).alias("m")).coalesce(files), "least")
    tied = edges.join(least, F.col("u") == F.col("_u")).where(taken).select(F.col("v").alias("u"), F.col("m").alias("v"))
    if own:
        tied = tied.unionByName(least.select(F.col("_u").alias("u"), F.col("m").alias("v")))
    out = scratch.write(tied.where(F.col("u") != F.col("v")).distinct().coalesce(files), "star")
    scratch.remove(least)
    return out
