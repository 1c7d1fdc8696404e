"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: every larger neighbour of a node is hung on the smallest node
    in reach.  Small star: every smaller neighbour (and the node) is."""
    both = edges.select("a", "b").unionByName(
        edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large \
        else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")) \
        .withColumn("m", F.least("a", "m"))
    hung = both.join(least, "a")
    if large:
        out = hung.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = hung.select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); root is its component's
    smallest node.  Each round is stored, so a lost executor costs one round.
    A hub's rows are split by the adaptive skew join; its minimum is
    pre-aggregated."""
    now = stored(edges.where("a <> b"), "edges")
    before = None
    while True:
        now = stored(_star(_star(now, True), False), "edges")
        state = now.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(
            F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("s")).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
