"""Connected components of a table of links, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.session import settle


def _downward(links: DataFrame) -> DataFrame:
    """Each link once, from the larger to the smaller node."""
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """Link the larger neighbours of every node to the least node of its neighbourhood."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Link the smaller neighbours of every node, and the node, to the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("low"))
    others = links.join(least, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return others.union(least.select("a", F.col("low").alias("b")))


def _not_done(links: DataFrame) -> DataFrame:
    """Nodes that have two lower neighbours, or a lower and a higher one: none is left when all links are stars."""
    ends = links.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("down")), F.struct(F.col("b").alias("node"), F.lit(0).alias("down")))).alias("e"))
    counts = ends.groupBy("e.node").agg(F.sum("e.down").alias("down"), F.min("e.down").alias("low"))
    return counts.filter("down > 1 OR down = 1 AND low = 0")


def components(links: DataFrame) -> DataFrame:
    """The least node of its component for every node that has a link: columns ``node`` and ``root``.

    ``links`` has two columns of whole numbers, in any order and with repeats. Links with a null end and
    links of a node to itself are ignored; an empty table gives an empty one. Each round is two stars;
    the rounds are logarithmic in the size of a component. Nothing of a component is gathered in one
    place: minima are aggregated, and adaptive execution splits the join of a node with many links.
    """
    first, second = links.columns
    now = settle(_downward(links.select(F.col(f"`{first}`").alias("a"), F.col(f"`{second}`").alias("b"))))
    while not _not_done(now).isEmpty():
        now = settle(_downward(_small_star(_downward(_large_star(now)))))
    lows = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(lows)
