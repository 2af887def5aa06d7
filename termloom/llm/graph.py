"""Connected components by alternating star contractions, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import discard, materialise


def _large(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to its smallest one."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame, name: str = "links", rounds: int = 60) -> DataFrame:
    """edges: columns a, b (numbers; loops and repeats don't matter). One row per node that has a link to another:
    node, component (its smallest node). Each round is written to the shared folder, and the one before it deleted."""
    now = materialise(edges.select("a", "b").where("a <> b").distinct(), name)
    before = None
    for _ in range(rounds):
        last, now = now, materialise(_small(_large(now)).where("a <> b").distinct(), name)
        discard(last)
        digest = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(digest) == before:
            break
        before = tuple(digest)
    else:
        raise RuntimeError("the components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())
