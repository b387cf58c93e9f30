"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmeter.llm.stored import stored


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("m"))


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for all nodes of ``edges``.

    ``edges`` has two columns of comparable ids; direction, repetition and loops are of no
    account. Large and small stars in turn: every node hands its smallest neighbour to the
    larger ones, then to all; the number of rounds grows with the logarithm of the longest
    chain. A node of many links has one row for each, met by a join that Spark may split.
    """
    a, b = edges.columns
    links = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    links = stored(links.where("a > b").distinct(), "links")
    before = _fingerprint(links)
    while before[0]:
        both = links.union(links.select("b", "a"))
        low = _smallest(both).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.distinct(), "large-stars")
        low = _smallest(large)
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(low.select("a", F.col("m").alias("b")))
        links = stored(small.where("a > b").distinct(), "small-stars")
        after = _fingerprint(links)
        if after == before:
            break
        before = after
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return nodes.union(roots)
