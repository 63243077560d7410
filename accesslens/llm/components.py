"""Connected components of a graph of links, by alternating star steps.

Each round hangs every node's larger neighbours on its smallest one, then its
smaller neighbours too; rounds end when the links no longer change, which takes
about log(n) of them. Every step is an aggregate and a join over stored tables;
nothing but a checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accesslens.llm.common import stored


def _checksum(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def _step(neighbours: DataFrame, larger: bool) -> DataFrame:
    """``neighbours`` (u, v): v sees u's smallest neighbour; ``larger``: only v above u move."""
    least = neighbours.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    rows = neighbours.join(stored(least, "least"), "u")
    if larger:
        moved = rows.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = rows.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            rows.select("u", F.col("m").alias("v"))
        )
    return stored(moved.filter(F.col("u") != F.col("v")).distinct(), "links")


def components(links: DataFrame) -> DataFrame:
    """``links`` (u, v) with u != v, either way round. Rows ``node``, ``root`` (the smallest
    node reachable) for every node that has a link and is not its own root."""
    down = F.struct(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    links = stored(links.select(down.alias("l")).select("l.*").distinct(), "links")
    before = None
    while (now := _checksum(links)) != before:
        before = now
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        links = _step(_step(both, True), False)
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
