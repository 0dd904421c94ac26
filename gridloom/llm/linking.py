"""Links between members of buckets: every pair that shares a bucket is compared or is in one component already."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.components import components
from gridloom.session import noted


def shared_buckets(rows: DataFrame) -> DataFrame:
    """``bucket``, ``node``, ``pos`` (place of the bucket in the node's order) and ``score`` for buckets of two nodes or more.

    Of buckets with the same nodes only the one first in the nodes' common order stays. The score of a node is the
    number of members of all its buckets: high for one that many others are like. Buckets are counted by partial
    aggregation of their hashes alone, and only rows of the shared ones carry more; none is gathered in one task.
    """
    shared = noted(rows.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket"))
    many = noted(rows.join(shared, "bucket", "left_semi").groupBy("bucket", "node").agg(F.min("pos").alias("pos")))
    size, x, y = F.count("*").alias("m"), F.bit_xor("node").alias("x"), F.bit_xor(F.xxhash64("node")).alias("y")
    sizes = many.groupBy("bucket").agg(size, x, y, F.sum("pos").alias("places")).filter("m > 1")
    once = sizes.groupBy("m", "x", "y").agg(F.min(F.struct("places", "bucket")).alias("f")).select("f.bucket", "m")
    kept = noted(many.join(once, "bucket"))
    return kept.join(noted(kept.groupBy("node").agg(F.sum("m").alias("score"))), "node").select("bucket", "node", "pos", "score")


def _met(m: DataFrame, p: DataFrame, condition: Column) -> DataFrame:
    """Distinct pairs (``a``, ``b``) of members of a bucket for which ``condition`` holds."""
    met = m.alias("m").join(p.alias("p"), (F.col("m.bucket") == F.col("p.bucket")) & condition)
    return met.select(F.least("m.node", "p.node").alias("a"), F.greatest("m.node", "p.node").alias("b")).distinct()


def linked(
    tables: list[DataFrame], facts: DataFrame, near: str, alike: Callable[[DataFrame], DataFrame], first_facts: DataFrame | None = None, first_near: str | None = None
) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) of the nodes linked to another one.

    ``tables`` come from ``shared_buckets``; the last one decides, others are there to connect what is very much alike at
    little cost. ``facts`` has more columns of each node; ``near`` is an SQL condition on two members ``p`` and ``m`` of
    a bucket that no true pair fails; ``alike`` takes pairs (``a``, ``b``) and keeps the true ones.

    First one member of each bucket of all tables, the one with the highest score, meets all others (by ``first_facts`` and
    ``first_near``, if they are given); then all members meet, but only those of different components. The result is
    that of all pairs: no pair is left out but those that are connected already, and none is verified twice.
    """
    first_facts, first_near = (facts, near) if first_facts is None else (first_facts, first_near)
    rows = reduce(DataFrame.unionByName, tables)
    best = rows.groupBy("bucket").agg(F.max(F.struct("score", F.xxhash64("node").alias("h"), "node")).alias("f")).select("bucket", "f.node")
    pivots = rows.join(best, ["bucket", "node"], "left_semi").join(first_facts, "node")
    tested = noted(_met(rows.join(first_facts, "node"), pivots, (F.col("m.node") != F.col("p.node")) & F.expr(first_near)))
    found = noted(alike(tested).select("a", "b"))
    stars = noted(components(found))

    labelled = tables[-1].join(stars, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root")
    mixed = labelled.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("bucket")
    left = noted(labelled.join(mixed, "bucket", "left_semi")).join(facts, "node")
    pairs = _met(left, left, (F.col("p.node") < F.col("m.node")) & (F.col("m.label") != F.col("p.label")) & F.expr(near))
    pairs = noted(pairs.join(tested, ["a", "b"], "left_anti"))
    if pairs.isEmpty():
        return stars
    more = noted(alike(pairs).select("a", "b"))
    return stars if more.isEmpty() else noted(components(more.union(stars.select("node", "root"))))
