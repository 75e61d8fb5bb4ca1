"""Connected components of links between long ids, by alternating large and small stars.

Each round hangs the neighbours of a node on its least neighbour; least values
are aggregated before the shuffle, so a node with very many links is no hot
spot, and each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm.tables import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links: (a, b) with a > b. Large: the larger neighbours of each node hang on its least; small: the smaller ones."""
    both = links.union(links.select("b", "a")) if large else links
    least = both.groupBy("a").agg(F.least(F.min("b"), F.min("a")).alias("low"))
    joined = both.join(least, "a")
    if large:
        return joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    hung = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).union(joined.select("a", F.col("low").alias("b")))
    return hung.filter(F.col("a") > F.col("b"))


def roots(links: DataFrame) -> DataFrame:
    """node, root for every node with a link: root is the least node of its component. links: columns a and b, in any order."""
    low, high = F.least("a", "b"), F.greatest("a", "b")
    now = links.filter(F.col("a") != F.col("b")).select(high.alias("a"), low.alias("b")).distinct()
    now, seen = stored(now, "links"), None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
        now = stored(_star(_star(now, large=True).distinct(), large=False).distinct(), "links")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
