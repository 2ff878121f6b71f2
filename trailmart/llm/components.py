"""Connected components of a link table, by alternating large and small stars.

A round is a few joins and groupings over the links; nothing is gathered in one place, the minima are taken
in each task before the shuffle, and adaptive joins split a node with very many links. Every round's links
are written to the shared folder. The number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node with a link; ``links`` has whole numbers ``a, b``, in any order and number.

    The component is the smallest node that can be reached. Null ends and links to itself are left out.
    """
    stars = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    stars = written(stars, "links")
    seen = _mark(stars)
    while seen[0]:
        both = stars.select("a", "b").unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        stars = written(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        now = _mark(stars)
        if now == seen:
            break
        seen = now
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _mark(links: DataFrame) -> tuple:
    """Number of links and a checksum of the set."""
    high = F.shiftright(F.xxhash64("a", "b"), 20)
    return tuple(links.agg(F.count("*"), F.coalesce(F.sum(high), F.lit(0))).first())
