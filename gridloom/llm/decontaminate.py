"""Benchmark decontamination: size-partitioned MinHash containment search for short test items in long
documents, verified by exact shingle containment. DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.session import fresh_path, noted

SHINGLE = 5
CONTAINMENT = 0.8

# Largest chance that the sketch of an item misses a text that holds exactly CONTAINMENT of it.
MISS = 1e-6

# Fixed value: the ASCII characters between words.
SPACE = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Words of a text in lower case; a null text has none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACE), lambda w: w != "")


def shingles(of: str, size: int = SHINGLE) -> Column:
    """Hashes of the shingles of a column of words; fewer words than ``size`` are one shingle."""
    w, n = F.col(of), F.size(of)
    whole = F.transform(F.sequence(F.lit(0), n - size), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)]))
    return F.when(n >= size, whole).when(n > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<bigint>"))


def bands_of(rows: int, threshold: float, miss: float = MISS) -> int:
    """Bands of ``rows`` minima of which at least one is wholly inside a text, but for the chance ``miss``."""
    return math.ceil(math.log(miss) / math.log(1 - threshold**rows))


def sketches(items: DataFrame, threshold: float) -> DataFrame:
    """MinHash bands of items (``_item``, ``h``, ``n``), by size class: ``_item``, ``band``, ``rows``, ``h``.

    An item's minimum under one hash function is a random one of its shingles, so a text with a share of
    them holds that minimum with that chance. Items of under 32 shingles get bands of one minimum;
    larger ones, whose single shingles are common in long texts, more bands of two.
    """
    parts = []
    for rows, size in ((1, F.col("n") < 32), (2, F.col("n") >= 32)):
        n = bands_of(rows, threshold)
        ordered = [F.min_by("h", F.xxhash64("h", F.lit(j))).alias(f"m{j}") for j in range(n * rows)]
        minima = items.filter(size).groupBy("_item").agg(*ordered)
        band = [F.struct(F.lit(i).alias("band"), F.array_distinct(F.array(*[F.col(f"m{i * rows + j}") for j in range(rows)])).alias("hs")) for i in range(n)]
        parts.append(minima.select("_item", F.explode(F.array(*band)).alias("s")).select("_item", "s.band", F.size("s.hs").alias("need"), F.explode("s.hs").alias("h")))
    return parts[0].union(parts[1])


def contained(docs: DataFrame, items: DataFrame, threshold: float = CONTAINMENT, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """Pairs of a document and a test item of whose distinct shingles the document has at least ``threshold``:
    both keys, ``n_found``, ``n_shingles``.

    Words are in lower case, between ASCII white space; shingles have five. Items and texts of fewer words are one
    shingle and match only an equally short text. Null and empty texts and items have none and match
    nothing. Rows with one key are one document (or item) with the shingles of all; null keys are a key
    of their own. Other columns are not looked at; empty tables give an empty table.

    Documents are read once: their shingle hashes are cut down to those of any item by a join with the
    item's hashes (a written table, so the optimizer knows its bytes), and only these few rows are kept, for candidates
    (a whole band of minima is in the document) and for the exact count.
    """
    spark = docs.sparkSession
    tests = items.select(F.col(f"`{item_key}`").alias("_item"), words(F.col(f"`{item_text}`")).alias("_w"))
    tests = tests.select("_item", F.explode(shingles("_w")).alias("h")).groupBy("_item").agg(F.collect_set("h").alias("hs"))
    tests = noted(tests.select("_item", F.size("hs").alias("n"), F.explode("hs").alias("h")))
    known = noted(tests.select("h").distinct())
    texts = docs.select(F.col(f"`{key}`").alias("_key"), words(F.col(f"`{text}`")).alias("_w"))
    path = fresh_path(spark, "hits")
    texts.select("_key", F.explode(shingles("_w")).alias("h")).join(known, "h", "left_semi").distinct().write.parquet(path)
    hits = spark.read.parquet(path)

    sketch = noted(sketches(tests, threshold))
    found = hits.join(sketch, "h").groupBy("_key", "_item", "band").agg(F.count("*").alias("has"), F.first("need").alias("need"))
    pairs = found.filter("has >= need").select("_key", "_item").distinct()
    wanted = pairs.alias("p").join(tests.alias("t"), F.col("p._item").eqNullSafe(F.col("t._item"))).select("p._key", "p._item", "h", "n")
    exact = wanted.alias("a").join(hits.alias("b"), F.col("a._key").eqNullSafe(F.col("b._key")) & (F.col("a.h") == F.col("b.h")))
    counted = exact.groupBy("a._key", "a._item").agg(F.count("*").alias("n_found"), F.first("n").alias("n_shingles"))
    passed = counted.filter(F.col("n_found") >= F.lit(threshold) * F.col("n_shingles"))
    return passed.select(F.col("_key").alias(key), F.col("_item").alias(item_key), "n_found", "n_shingles")


def without(docs: DataFrame, rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` but for those whose key is in ``rows``. A null key is a key."""
    gone = noted(rows.select(F.col(f"`{key}`").alias("_gone")).distinct())
    return docs.join(gone, docs[f"`{key}`"].eqNullSafe(gone["_gone"]), "left_anti")
