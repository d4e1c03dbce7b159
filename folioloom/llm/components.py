"""Connected components of links between keys, by alternating large-star and small-star rounds.

A round is two stars, whose rows never exceed twice the links; each round is written to the shared folder, so lineage
stays short and lost executors cost a stage. Minima are aggregated before the shuffle; the links of a hot key meet
their minimum in a plain join, which adaptive execution splits. Rounds go on until nothing changes: a round cuts
the height of the trees, so they are about the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, written


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Every key's neighbours (larger: only those above it; else those below) move to its least neighbour."""
    if larger:
        pairs = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        pairs = links  # u > v
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    moved = pairs.join(least, "u")
    if larger:
        moved = moved.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        own = least.select("u", F.col("m").alias("v"))
        moved = moved.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own)
    return moved.where(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """links: u, v of one type. Returns u, root for every key that isn't the least of its component."""
    links = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(F.col("u") != F.col("v"))
    links = written(links.distinct(), "links")
    sums = lambda df: tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
    before = sums(links)
    while before[0]:
        old, links = links, written(_star(_star(links, True), False), "links")
        release(old)
        if (now := sums(links)) == before:
            break
        before = now
    return links.select("u", F.col("v").alias("root"))
