"""Connected components by alternating large and small stars, on DataFrames; every round ends in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node that node is linked to, for all nodes of the edges (a, b: longs). Self-links and repeated
    links don't matter; nulls are left out; no edges give no rows. Rounds grow with the logarithm of the nodes. A node with very
    many links, such as a star's centre, is joined by broadcast, so that its links stay where they are."""
    edge = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = C.spool(edge, "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = C.attach(both, least, "u", "n", 2 * mark[0]).where("v > u and v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        large = C.spool(large, "edges")
        root = large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n"))
        small = C.attach(large, root, "a", "n", 2 * mark[0]).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        following = C.spool(small.union(root.select("a", F.col("m").alias("b"))).distinct(), "edges")
        before, mark = mark, _mark(following)
        now = following
        if mark == before:
            break
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(stars.select("root", "root").distinct())


def _mark(edges: DataFrame) -> tuple[int, int]:
    return tuple(edges.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first())
