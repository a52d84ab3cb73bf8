"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granero.session import stage


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % F.lit(2**31))).first())


def components(links: DataFrame) -> DataFrame:
    """node, root: the smallest node that links reach, for every node of ``links`` (a, b: long).

    Each round hangs the larger neighbours of a node, then the smaller ones, on
    the smallest; both are a minimum per node (combined before the shuffle) and a
    join back. The number of rounds grows with the logarithm of the longest
    chain. No round gathers a group.
    """
    pairs = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    stars = stage(pairs.distinct(), "stars")
    before = None
    while (now := _state(stars)) != before:
        before = now
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        own = lowest.select("a", F.col("m").alias("b"))
        stars = stage(hung.unionByName(own).where("a <> b").distinct(), "stars")
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
