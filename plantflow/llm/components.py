"""Connected components of links between numbers, as joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantflow.llm import common


def smallest_reachable(links: DataFrame) -> DataFrame:
    """For each number in the links (a, b): node, and component, the smallest number reachable.

    Alternates two steps that keep components as they are: every node points its larger neighbours to the smallest
    number around it, then its smaller ones. Stars are left after about log(size) rounds; each round is written to the
    shared folder, so that lineage stays short and a lost executor costs one round. Hubs are groupings by key with
    partial aggregation and joins, which Spark may split; no component is ever gathered anywhere.
    """
    links = common.cut(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (
            both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(links.groupBy("a").agg(F.min("b").alias("b")))  # of a node itself
            .filter("a <> b").distinct()
        )
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(lowest.select("a", F.col("m").alias("b")))
            .filter("a <> b").distinct()
        )
        after = common.cut(small)
        if _same(links, after):
            return after.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                after.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        links = after


def _same(x: DataFrame, y: DataFrame) -> bool:
    """Both are sets: equal if their sizes and sums of hashes are."""
    figures = [F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("b", "a"))]
    return x.agg(*figures).first() == y.agg(*figures).first()
