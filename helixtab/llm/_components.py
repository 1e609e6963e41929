"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixtab.llm._util import stored


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy("a").agg(F.min("b").alias("m"))


def components(links: DataFrame) -> DataFrame:
    """(a, b) links between longs to (a, b): each node but the least of its component, and that least.

    Every step replaces links by links to smaller nodes and keeps components; the links are
    written after each round, and rounds end when none changes. Nothing but a count and a
    checksum reaches the driver.
    """
    now = stored(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = None
    while True:
        seen = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if seen == mark or not seen[0]:
            return now
        mark = seen
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _least(both).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = _least(large)
        small = large.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stored(small.unionAll(least.select("a", F.col("m").alias("b"))).distinct(), "links")
