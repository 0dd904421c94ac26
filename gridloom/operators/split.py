"""Reproducible splits, folds, shuffles, batches and rare-bin merging."""

from __future__ import annotations

import random
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.binning import cut_uniform
from gridloom.operators.quantiles import md5_order, rows_at, shuffled_rank
from gridloom.session import lookup_join, noted, with_params

# Parts in which remainders are counted.
PARTS = 4096


def _quotas(strata: DataFrame, percent: int, stratum: str, by: list[str]) -> DataFrame:
    """by..., stratum, quota: test rows of each stratum by largest remainder; ties go to the smaller stratum.

    Remainders are counted in PARTS parts; only the strata of a part are ordered together, so that many strata
    need no single-task sort.
    """
    totals = strata.groupBy(*by).agg(F.sum("n_s").alias("n"))
    n_test = F.expr(f"cast((n * {int(percent)} + 99) div 100 as bigint)")
    strata = lookup_join(strata, totals, by, "inner").withColumn("n_test", n_test)
    strata = strata.withColumn("base", F.expr("(n_test * n_s) div n")).withColumn("rest", F.expr("(n_test * n_s) % n"))
    strata = strata.withColumn("_part", F.expr(f"-(rest * {PARTS} div n)"))
    parts = strata.groupBy(*by, "_part").agg(F.count("*").alias("size"), F.sum("base").alias("base"), F.max("n_test").alias("n_test"))
    parts = parts.groupBy(*by).agg(F.collect_list(F.struct("_part", "size")).alias("_parts"), (F.max("n_test") - F.sum("base")).alias("spare"))
    order = F.row_number().over(Window.partitionBy(*by, "_part").orderBy(F.col("rest").desc(), F.col(f"`{stratum}`").asc_nulls_last()))
    ranked = lookup_join(strata.withColumn("_order", order), parts, by, "inner")
    ahead = F.aggregate("_parts", F.lit(0).cast("bigint"), lambda n, part: n + F.when(part["_part"] < F.col("_part"), part["size"]).otherwise(0))
    ranked = ranked.withColumn("ahead", ahead)
    quota = F.col("base") + F.when(F.col("_order") + F.col("ahead") <= F.col("spare"), 1).otherwise(0)
    return ranked.select(*by, F.col(f"`{stratum}`"), F.when(F.col("n_s") == 1, 0).otherwise(quota).cast("bigint").alias("quota"))


def _mark_test(df: DataFrame, percent: int, key: str, stratum: str, by: list[str]) -> DataFrame:
    """``df`` with is_test, given the md5 order of each row in ``_h``.

    A stratum's test rows are the first ones of its md5 order, so the split is one cut point per
    stratum. The table itself is neither shuffled nor sorted.
    """
    every = [*by, "_all"]
    df = df.withColumn("_all", F.lit(0))
    keys = [*every, stratum]
    quotas = _quotas(noted(df.groupBy(*keys).agg(F.count("*").alias("n_s"))), percent, stratum, every)
    points = rows_at(df.select(*keys, "_h", key), quotas.filter("quota > 0").withColumnRenamed("quota", "take"), keys, key).drop("take")
    points = noted(points)  # one row per stratum; rows are marked by it without another look at the order
    split = lookup_join(df, points, keys)
    here = F.struct(F.col("_h").alias("h"), F.col(key).alias("k"))
    return split.withColumn("is_test", F.coalesce(here <= F.col("_cut"), F.lit(False))).drop("_cut", "_h", "_all")


def stratified_split(df: DataFrame, percent: int, seed: int, key: str, stratum: str) -> DataFrame:
    """Adds is_test: ceil(percent% of the rows), shared among the strata by largest remainder.

    ``key`` must be unique. A stratum of one row stays in training.
    """
    return _mark_test(df.withColumn("_h", md5_order(seed, key)), percent, key, stratum, [])


def train_val_test(df: DataFrame, key: str, stratum: str, seeds: tuple[int, int] = (42, 41)) -> DataFrame:
    """70/15/15 by two chained splits; adds part: train, val or test."""
    first = stratified_split(df, 30, seeds[0], key, stratum)
    rest = stratified_split(first.filter("is_test").drop("is_test"), 50, seeds[1], key, stratum)
    train = first.filter(~F.col("is_test")).drop("is_test").withColumn("part", F.lit("train"))
    return train.unionByName(rest.withColumn("part", F.when(F.col("is_test"), "test").otherwise("val")).drop("is_test"))


def holdout_seeds(k: int = 3, seed: int = 42) -> list[int]:
    """k seeds in 0..100 from a seeded generator."""
    generator = random.Random(seed)
    return [generator.randint(0, 100) for _ in range(k)]


def repeated_holdout(df: DataFrame, key: str, stratum: str, k: int = 3, seed: int = 42, percent: int = 20) -> DataFrame:
    """Every row once per fold, with fold, the fold's seed and is_test; all folds are split together."""
    seeds = holdout_seeds(k, seed)
    folds = F.explode(F.array(*[F.struct(F.lit(i).alias("fold"), F.lit(s).alias("seed")) for i, s in enumerate(seeds)]))
    rows = df.withColumn("_f", folds).select(*df.columns, "_f.fold", "_f.seed")
    rows = rows.withColumn("_h", F.md5(F.concat(F.col("seed").cast("string"), F.col(key).cast("string")).cast("binary")))
    return _mark_test(rows, percent, key, stratum, ["fold"])


def kfold(df: DataFrame, key: str, k: int = 10, out: str = "fold", seed: int = 42) -> DataFrame:
    """Folds of equal size in the shuffle order of ``seed``; the first ``rows % k`` folds hold one more.

    Folds are ranges of the md5 order, so only the k-1 first rows of the later folds are looked up, and rows that
    stand together in the file are in different folds. Null keys make no row of their own; keys are unique.
    """
    rows = df.select(F.lit(0).alias("_all"), md5_order(seed, key).alias("_h"), F.col(key))
    starts = rows.groupBy("_all").agg(F.count("*").alias("n")).withColumn("f", F.explode(F.sequence(F.lit(1), F.lit(max(1, k - 1)))))
    starts = starts.select("_all", F.expr(f"f * (n div {k}) + least(f, n % {k}) + 1").alias("take"), "n").filter("take <= n").drop("n")
    cuts = rows_at(rows, starts.distinct() if k > 1 else starts.limit(0), ["_all"], key).agg(F.collect_list("_cut").alias("cuts"))
    here = F.struct(md5_order(seed, key).alias("h"), F.col(key).alias("k"))
    marked = with_params(df, cuts).withColumn(out, F.size(F.filter("_fit.cuts", lambda c: c <= here)))
    return marked.drop("_fit")


def shuffle(df: DataFrame, seed: int, key: str) -> DataFrame:
    """Rows in a reproducible random order (a range-partitioned sort)."""
    return df.orderBy(md5_order(seed, key), key)


def batches(df: DataFrame, size: int, seed: int, key: str, out: str = "batch") -> DataFrame:
    """Batch number of each row in shuffle order; the last batch may be partial."""
    ranked = shuffled_rank(df, seed, key, "_rank")
    return ranked.withColumn(out, F.expr(f"_rank div {int(size)}")).drop("_rank")


def steps_per_epoch(df: DataFrame, size: int) -> DataFrame:
    """One row: number of full batches."""
    return df.agg(F.expr(f"count(*) div {int(size)}").alias("steps"))


def bin_and_merge_rare(
    df: DataFrame, value: str, width: float = 0.1, count: int = 1000, minimum: int = 2, out: str = "bin",
) -> DataFrame:
    """Right-closed bin number as text, ``Other`` for bins with fewer than ``minimum`` rows, NULL outside.

    Bin counts (at most ``count``) are turned into one array of flags, so no row moves to another task.
    """
    binned = df.withColumn("_bin", cut_uniform(F.col(f"`{value}`"), width, count))
    sizes = binned.filter(F.col("_bin").isNotNull()).groupBy("_bin").agg(F.count("*").alias("size"))
    kept = F.collect_list(F.when(F.col("size") >= minimum, F.col("_bin")))
    flags = F.transform(F.sequence(F.lit(1), F.lit(count)), lambda i: F.array_contains(F.col("_kept"), i))
    fitted = sizes.agg(kept.alias("_kept")).select(flags.alias("common"))
    marked = with_params(binned, fitted)
    label = F.when(F.get(F.col("_fit.common"), F.col("_bin") - 1), F.col("_bin").cast("string")).otherwise("Other")
    return marked.withColumn(out, F.when(F.col("_bin").isNotNull(), label)).drop("_bin", "_fit")
