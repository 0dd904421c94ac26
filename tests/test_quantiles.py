"""Order statistics and ranks: the path for large tables against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.operators import quantiles, split
from gridloom.session import with_row_key


def test_percentiles_by_group(spark):
    draw = random.Random(3)
    rows = [(draw.choice(["a", "a", "a", "b"]), draw.choice([0.0, draw.gauss(0, 1), draw.lognormvariate(0, 2), float("nan")]), float(i % 7)) for i in range(3000)]
    rows += [(None, 1.0, None), (None, 2.0, 5.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {(r["g"], r["name"]): (r["n"], r["q"]) for r in quantiles.exact_percentiles(df, ["x", "y"], probs, ["g"]).collect()}
    for g in ("a", "b", None):
        for k, name in ((1, "x"), (2, "y")):
            v = [r[k] for r in rows if r[0] == g and r[k] is not None and not np.isnan(r[k])]
            n, q = got[(g, name)]
            assert n == len(v)
            assert q == pytest.approx(list(np.percentile(v, [100 * p for p in probs])), rel=1e-12, abs=1e-12)


def test_hot_value_and_constant(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 700, 5.0).otherwise(F.col("id").cast("double")).alias("x"), F.lit(2.0).alias("c"))
    row = quantiles.percentile_row(df, ["x", "c"], [k / 99 for k in range(100)]).first()
    v = [5.0] * 700 + [float(i) for i in range(700, 1000)]
    assert row["x"] == pytest.approx(list(np.percentile(v, [100 * k / 99 for k in range(100)])))
    assert row["c"] == [2.0] * 100


def test_kfold_cuts_the_shuffle_order(spark):
    keys = random.Random(5).sample(range(100_000), 1003)
    want = {k: f for f, part in enumerate(np.array_split(sorted(keys, key=lambda k: (hashlib.md5(f"42{k}".encode()).hexdigest(), k)), 10)) for k in part}
    for parts in (1, 3, 13):
        df = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(parts)
        assert {r["k"]: r["fold"] for r in split.kfold(df, "k", 10).collect()} == want
    small = split.kfold(spark.range(3).withColumnRenamed("id", "k"), "k", 5).collect()
    assert sorted(r["fold"] for r in small) == [0, 1, 2]


def test_row_keys_do_not_depend_on_the_layout(spark):
    rows = [(i % 50, None if i % 7 == 0 else float(i % 5)) for i in range(400)]
    found = []
    for parts in (1, 3, 13):
        df = with_row_key(spark.createDataFrame(rows, "a int, b double").repartition(parts))
        found.append(sorted(map(tuple, df.collect()), key=str))
    assert found[0] == found[1] == found[2] and len({r[2] for r in found[0]}) == 400


def test_infinite_and_absent_values(spark):
    inf = float("inf")
    df = spark.createDataFrame([(1.0, None), (2.0, None), (inf, None), (-inf, None), (3.0, None)], "x double, none double")
    row = quantiles.percentile_row(df, ["x", "none"], [0.0, 0.5, 1.0]).first()
    assert row["x"] == [-inf, 2.0, inf] and row["none"] is None


def test_shuffled_rank_is_global(spark):
    df = spark.range(5000).withColumnRenamed("id", "k").repartition(7)
    got = {r["k"]: r["rank"] for r in quantiles.shuffled_rank(df, 9, "k").collect()}
    order = sorted(range(5000), key=lambda k: (hashlib.md5(f"9{k}".encode()).hexdigest(), k))
    assert got == {k: i for i, k in enumerate(order)}
    assert [r["k"] for r in split.shuffle(df, 9, "k").collect()] == order


def test_every_level_of_the_tree(spark):
    """Values that differ in their last digits only, equal ones, signs, zeros, subnormal and infinite ones: with a leaf of one
    row the descent ends at the last level."""
    draw = random.Random(11)
    values = [1000.0 + i * 2.0**-40 for i in range(300)] + [-5.0] * 200 + [0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, float("inf")]
    values += [draw.gauss(0, 1) for _ in range(500)]
    draw.shuffle(values)
    probs = [k / 50 for k in range(51)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for leaf in (1, 50, 10**6):
        q = quantiles.exact_percentiles(df, ["x"], probs, leaf=leaf).first()["q"]
        order = sorted(values)
        for p, got in zip(probs, q):
            at = p * (len(order) - 1)
            low, high = order[int(np.floor(at))], order[int(np.ceil(at))]
            assert got == (low if low == high else pytest.approx(low + (high - low) * (at - np.floor(at)), rel=1e-12))


def test_images_follow_the_order(spark):
    draw = random.Random(12)
    values = sorted([draw.uniform(-1, 1) * 10.0 ** draw.randint(-300, 300) for _ in range(3000)] + [np.nextafter(1.0, k) for k in (0, 2)] + [1.0, 0.0, float("-inf")])
    got = [r[0] for r in spark.createDataFrame([(float(v),) for v in values], "x double").select(quantiles.image(F.col("x"))).collect()]
    assert got == sorted(got) and len(set(got)) > 2990


@pytest.mark.parametrize("shape", ["normal", "long tail", "a code far outside"])
def test_small_share_of_rows_is_ordered_together(spark, shape):
    """At most one row in 100,000 is in a cell that is ordered in one task."""
    x = {"normal": F.randn(1), "long tail": F.exp(F.randn(1) * 3), "a code far outside": F.when(F.rand(2) < 0.001, 9.97e36).otherwise(0.5 + F.randn(1) * 0.1)}[shape]
    df = spark.range(1_000_000).select(x.alias("x"))

    def wants(parts):
        return parts.withColumn("rank", F.explode(F.expr("transform(sequence(0, 20), k -> cast(k * (n - 1) div 20 as bigint))")))

    rows = df.select("x", F.lit(0).alias("g"), quantiles.image(F.col("x")).alias("image"))
    cells, _ = quantiles.located(rows, ["g"], quantiles.VALUE_LEVELS, wants, leaf=10)
    sizes = cells.groupBy("_cell", "x").count().groupBy("_cell").count().agg(F.max("count")).first()[0]
    assert sizes <= 10
