"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.shared import stored


def _towards_least(sym: DataFrame, larger_only: bool) -> DataFrame:
    """Link the neighbours ``v`` of each ``u`` to the least of ``u`` and its neighbours."""
    least = sym.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), F.least("u", "m").alias("m"))
    linked = sym.join(least, F.col("u") == F.col("_u"))
    if larger_only:
        return linked.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        linked.select("u", F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (its component's least node) for every node of the links ``(u, v)``.

    The links shrink to stars in a number of rounds that grows with the logarithm of the longest chain.
    Hub nodes are joined to one row each, so Spark can split them. Each round's links are stored.
    """
    links = stored(links.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    seen = None
    while True:
        sym = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _towards_least(sym, larger_only=True).where("u <> v").distinct()
        small = _towards_least(
            large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), larger_only=False)
        links = stored(small.where("u <> v").distinct(), "links")
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        links.select("v", "v").distinct())
