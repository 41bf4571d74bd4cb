"""Connected components of a link table, on executors only.

Large-star and small-star rounds: every node points its larger neighbours,
then its smaller ones, to the smallest node it knows.  A round joins the
links with one row per node, so a node with very many links is a skewed join
side that adaptive execution splits, never a collected list.  Each round is
written to a work folder and the one before it dropped; the driver sees two
numbers per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_folders, land, work_dir


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) -> (id, component) for every node with a link.

    ``component`` is the smallest id that can be reached.  Direction,
    repeats, self-links and null ends do not matter; no links give no rows.
    """
    spark = links.sparkSession
    path = work_dir(spark, "edges")
    edges = land(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .filter(F.col("a").isNotNull() & F.col("b").isNotNull()
                         & (F.col("a") != F.col("b")))
                 .distinct(), path)
    before = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("n")).agg(F.least(F.min("b"), F.col("n")).alias("m"))
        # larger neighbours of a node point to the smallest of its neighbourhood
        stars = work_dir(spark, "stars")
        large = land(both.filter(F.col("b") > F.col("a")).join(low, F.col("a") == F.col("n"))
                     .select(F.col("b").alias("a"), F.col("m").alias("b"))
                     .filter(F.col("a") != F.col("b")).distinct(), stars)
        low = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        small = large.join(low, F.col("a") == F.col("n"))
        old, path = path, work_dir(spark, "edges")
        edges = land(small.select(F.col("b").alias("a"), F.col("m").alias("b"))
                     .unionByName(small.select("a", F.col("m").alias("b")))
                     .filter(F.col("a") != F.col("b")).distinct(), path)
        drop_folders(spark, old, stars)
        now = _state(edges)
        if now == before:
            break
        before = now
    # every edge now goes from a node to its component
    return (edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
            .unionByName(edges.select(F.col("b").alias("id"), F.col("b").alias("component")))
            .distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
                 .first())
