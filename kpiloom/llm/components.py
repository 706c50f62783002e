"""Connected components of a graph given by its links, as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Joins every greater neighbour of a node to the node's least neighbour."""
    both = links.union(links.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, F.col("u") == F.col("c")).select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Joins a node and its lesser neighbours to the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), "m")
    moved = links.join(least, F.col("a") == F.col("c")).where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("c", "m")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component): each linked node with the least node it can reach.

    ``links`` has two long columns; order, repeats and loops don't matter. The
    two star steps alternate until nothing changes, which takes a few rounds
    even for long chains, and no round holds a node's neighbours in one place:
    minima are combined before the shuffle, and the joins back are plain ones,
    which adaptive execution splits at a node with very many links. Each round
    is written to the shared folder; only its number of rows and a checksum
    reach the driver.
    """
    a, b = links.columns
    now = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    now, before = stored(now, "links"), None
    while True:
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == before or mark[0] == 0:
            return now.toDF("id", "component").union(now.select("b").distinct().select("b", F.col("b")))
        before = mark
        now = stored(_small_star(_large_star(now)), "links")
