"""Splits: a partition with the right sizes, whatever the layout of the input."""

import hashlib
import math
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridloom.operators import split


def brute_split(rows, percent, seed):
    """rows: {key: stratum}; the keys of the test part by largest remainder."""
    n = len(rows)
    n_test = math.ceil(percent * n / 100)
    sizes = Counter(rows.values())
    base = {s: n_test * c // n for s, c in sizes.items()}
    left = n_test - sum(base.values())
    for s in sorted(sizes, key=lambda s: (-((n_test * sizes[s]) % n), s is None, s or ""))[:left]:
        base[s] += 1
    out = set()
    for s, c in sizes.items():
        order = sorted((k for k in rows if rows[k] == s), key=lambda k: (hashlib.md5(f"{seed}{k}".encode()).hexdigest(), k))
        out |= set(order[: 0 if c == 1 else base[s]])
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.sampled_from(["a", "a", "a", "b", "c", None, "rare"]), min_size=3, max_size=120), st.sampled_from([20, 30, 50]))
def test_split_equals_brute_force(spark, strata, percent):
    rows = dict(enumerate(strata))
    df = spark.createDataFrame(list(rows.items()), "k bigint, s string")
    got = split.stratified_split(df, percent, 42, "k", "s").collect()
    assert sorted(r["k"] for r in got) == sorted(rows)
    assert {r["k"] for r in got if r["is_test"]} == brute_split(rows, percent, 42)


def test_split_does_not_depend_on_layout(spark):
    df = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 5).alias("s"))
    parts = []
    for layout in (df, df.repartition(1), df.orderBy(F.desc("k")).repartition(13)):
        parts.append({r["k"] for r in split.stratified_split(layout, 20, 1, "k", "s").filter("is_test").collect()})
    assert all(p == parts[0] for p in parts) and len(parts[0]) == 600


def test_train_val_test(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), F.when(F.col("id") < 400, "hot").otherwise("rest").alias("s"))
    got = split.train_val_test(df, "k", "s").groupBy("s", "part").count().collect()
    counts = {(r["s"], r["part"]): r["count"] for r in got}
    assert counts == {("hot", "train"): 280, ("hot", "val"): 60, ("hot", "test"): 60, ("rest", "train"): 420, ("rest", "val"): 90, ("rest", "test"): 90}


def test_holdout_seeds():
    assert split.holdout_seeds(3, 42) == [81, 14, 3]


def test_folds_agree_with_single_splits(spark):
    df = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 3).cast("string").alias("s"))
    folds = split.repeated_holdout(df, "k", "s").filter("is_test")
    for fold, seed in enumerate([81, 14, 3]):
        one = {r["k"] for r in split.stratified_split(df, 20, seed, "k", "s").filter("is_test").collect()}
        assert {r["k"] for r in folds.filter(F.col("fold") == fold).collect()} == one


def test_batches(spark):
    df = spark.range(103).withColumnRenamed("id", "k")
    sizes = Counter(r["batch"] for r in split.batches(df, 16, 1, "k").collect())
    assert [sizes[i] for i in range(7)] == [16] * 6 + [7]
    assert split.steps_per_epoch(df, 16).first()["steps"] == 6


def test_rare_bins(spark):
    df = spark.createDataFrame([(0.0,), (0.05,), (0.15,), (50.0,), (50.0,), (100.5,), (None,)], "y double")
    got = [r["bin"] for r in split.bin_and_merge_rare(df, "y").collect()]
    assert got == ["1", "1", "Other", "500", "500", None, None]
