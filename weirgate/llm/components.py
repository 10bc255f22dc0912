"""Connected components of links, by the alternating large-star and small-star steps of a distributed union-find."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.session import remove, work_dir


def _larger_and_least(links: DataFrame, large: bool) -> DataFrame:
    """Large star: each node's larger neighbours meet its least one.  Small star: its smaller ones do."""
    if large:
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        met = both.where("b > a").join(least, "a").select(F.col("b").alias("x"), F.col("least").alias("y"))
    else:
        down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("least"))
        met = down.join(least, "a").select(F.col("b").alias("x"), F.col("least").alias("y"))
        met = met.union(least.select(F.col("a").alias("x"), F.col("least").alias("y")))
    met = met.where("x <> y")
    return met.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, its component's least node, for every node that has a link.

    ``links`` has the columns a and b, of one ordered type; rows may repeat, run either way or lead back to
    their node.  Rows with a null are no links.  Each round is written to the shared folder, so lineage stays
    short; rounds end when the links are stars, after about the logarithm of the longest path.
    """
    spark = links.sparkSession
    loops = links.where("a = b").select(F.col("a").alias("node"))
    first = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    path, now = _written(first.distinct())
    while not _is_stars(now):
        following, now = _written(_larger_and_least(_larger_and_least(now, large=True), large=False).distinct())
        remove(spark, path)
        path = following
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = now.select(F.col("b").alias("node")).union(loops)
    alone = centres.distinct().join(stars.select("node"), "node", "left_anti")
    return stars.union(alone.select("node", F.col("node").alias("component")))


def _is_stars(links: DataFrame) -> bool:
    """Whether each node leads to one lesser node at most, and none that is led to leads on: every component is then
    its least node and the nodes that lead to it."""
    leads = links.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
    led = links.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    nodes = leads.union(led).groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return nodes.where("out > 1 OR (out = 1 AND into = 1)").isEmpty()


def _written(links: DataFrame) -> tuple[str, DataFrame]:
    """Where the links were written, and what was written."""
    path = work_dir(links.sparkSession, "links")
    links.write.parquet(path)
    return path, links.sparkSession.read.schema(links.schema).parquet(path)
