"""Connected components of a link table, by alternating large-star and small-star steps.

Both steps replace links by links to a smaller neighbour and keep the components; when nothing
changes, every vertex is linked to the smallest of its component. Each round is written to shared
storage; only two sums per round come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import saved


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return (down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
            .union(least.select("a", F.col("m").alias("b"))).distinct())


def components(links: DataFrame) -> DataFrame:
    """(a, b) links -> (vertex, root): each linked vertex but the roots, with the smallest vertex
    of its component."""
    edges, seen = _kept(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    while seen[0]:
        edges, now = _kept(_small(_large(edges)))
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("vertex"), F.col("b").alias("root"))


def _kept(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The links on shared storage, and their number and sum of hashes, observed while writing."""
    sums = Observation()
    out = saved(edges.observe(sums, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")), "links")
    return out, (sums.get["n"], sums.get["h"])
