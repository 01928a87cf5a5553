"""Connected components of a table of links, by alternating stars.

Each round links every node to the smallest node it sees (large star), then to the smallest of its smaller neighbours
(small star), until nothing changes: the links are then stars around the smallest node of each component. Nothing but
two sums per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from semstore.llm.common import staged


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node and component (the smallest node reachable) for every node with a link; links has columns a and b, long.

    Links of a node to itself, repeated links and links with a null end are ignored.
    """
    stars = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
    stars = staged(stars.distinct(), "links")
    before = _state(stars)
    for _ in range(most_rounds):
        if not before[0]:
            break
        stars = staged(_small_star(_large_star(stars)), "links")
        after = _state(stars)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle within {most_rounds} rounds")
    own = stars.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return stars.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(own)


def _large_star(stars: DataFrame) -> DataFrame:
    both = stars.union(stars.select("u", "v")).toDF("x", "y")
    least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
    return both.where(F.col("y") > F.col("x")).join(least, "x").select(F.col("y").alias("v"), F.col("m").alias("u")).distinct()


def _small_star(stars: DataFrame) -> DataFrame:
    # every row has v > u: the neighbours of v that are smaller
    least = stars.groupBy("v").agg(F.min("u").alias("m"))
    joined = stars.join(least, "v")
    moved = joined.where(F.col("u") != F.col("m")).select(F.col("u").alias("v"), F.col("m").alias("u"))
    return moved.union(least.select("v", F.col("m").alias("u"))).distinct()


def _state(stars: DataFrame) -> tuple:
    return tuple(stars.agg(F.count("*"), F.bit_xor(F.xxhash64("v", "u")), F.sum(F.col("u").cast("decimal(38,0)"))).first())
