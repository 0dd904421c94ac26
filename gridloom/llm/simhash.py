"""SimHash near-duplicates found by covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.components import components
from gridloom.llm.text import Words, slices, texts_of, tidy
from gridloom.session import fresh_path, settle

BITS = 64
SEED = 42
RADIUS = 2

SLICE_BYTES = 1 << 20


def shingle_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle of ``size`` words (a shorter text is one shingle), and the bounds per text."""
    joined, starts = words.joined()
    counts = words.counts()
    shingles = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(shingles)])
    first = np.repeat(words.text_bounds[:-1] - bounds[:-1], shingles) + np.arange(bounds[-1])
    last = first + np.repeat(np.minimum(counts, size), shingles) - 1
    digest = xxhash.xxh64_intdigest
    ends = starts[last] + words.lengths[last]
    values = [digest(joined[a:b], SEED) for a, b in zip(starts[first].tolist(), ends.tolist(), strict=True)]
    return np.array(values, dtype=np.uint64), bounds


def fold_bits(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One fingerprint per text: a bit is 1 where over half of its hashes have it."""
    counts = np.diff(bounds)
    out = np.zeros(len(counts), dtype=np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        ones = np.add.reduceat(bits, bounds[some], axis=0, dtype=np.int32)
        out[some] = np.packbits(2 * ones > counts[some][:, None], axis=1).reshape(-1).view(np.uint64)
    return out


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` and its 64-bit SimHash as the signed long ``_print``.

    Words are split at ASCII white space of the text with A-Z in lower case; shingles count as often as
    they occur. A null or empty text, or one of white space only, has fingerprint zero.
    """
    keep = docs.columns if keep is None else keep
    read = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_hashed"))
    schema = T.StructType([*read.schema.fields[:-1], T.StructField("_print", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_hashed", SLICE_BYTES):
                words = Words(texts_of(part.column("_hashed")).lowered())
                prints = fold_bits(*shingle_hashes(words, shingle))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(prints.view(np.int64))], names=[*keep, "_print"])

    return read.mapInArrow(tidy(run), schema)


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """2 ** (radius + 1) - 1 bit masks, of which at least one leaves out any ``radius`` bits.

    Bit i has a vector of radius + 1 binary digits; mask v keeps the bits whose vector has an odd product with
    v. The vectors of ``radius`` bits do not span the space, so some v is orthogonal to all of them.
    """
    space = 1 << (radius + 1)
    vectors = [i % (space - 1) + 1 for i in range(bits)]
    return [sum(1 << i for i, x in enumerate(vectors) if (x & v).bit_count() % 2) for v in range(1, space)]


def signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def tables(prints: DataFrame, radius: int) -> DataFrame:
    """Each fingerprint once per hash table: its table, its bucket (the bits of the mask) and itself."""
    buckets = [F.struct(F.lit(k).cast("short").alias("t"), F.col("_print").bitwiseAND(F.lit(signed(m))).alias("bucket")) for k, m in enumerate(covering_masks(radius))]
    return prints.select("_print", F.explode(F.array(*buckets)).alias("_t")).select("_t.t", "_t.bucket", "_print")


def close_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links between distinct fingerprints (column ``_print``) at most ``radius`` (2 or less) bits apart, as
    columns ``a`` and ``b``: not all of them, but enough to connect what they connect.

    Every such pair shares a bucket of some table, where it differs in bits outside the mask only. Buckets
    with one fingerprint are dropped. In the others each fingerprint sends itself and its neighbours at one
    such bit; two fingerprints meet in a neighbour exactly if they differ in two bits or less. So a bucket
    of m fingerprints costs m times a constant, never m squared, and a meeting point has at most 65 members.
    """
    if radius > 2:
        raise ValueError("fingerprints meet half way at a radius of two or less")
    rows = tables(prints, radius)
    shared = rows.groupBy("t", "bucket").agg(F.count("*").alias("n")).filter("n > 1").select("t", "bucket")
    masks = covering_masks(radius)
    flips = F.array(*[F.array(F.lit(0).cast("long"), *[F.lit(signed(1 << i)) for i in range(BITS) if not m >> i & 1]) for m in masks])
    met = rows.join(shared, ["t", "bucket"], "left_semi").select(
        "_print", F.explode(F.transform(F.element_at(flips, F.col("t").cast("int") + 1), lambda x: x.bitwiseXOR(F.col("_print")))).alias("point")
    )
    groups = met.groupBy("point").agg(F.collect_set("_print").alias("all")).filter(F.size("all") > 1)
    return groups.select(F.array_min("all").alias("b"), F.explode("all").alias("a")).filter("a <> b").select("a", "b").distinct()


def rooted(distinct: DataFrame, radius: int) -> DataFrame:
    """``distinct`` (one row per ``_print``) with ``root``, a fingerprint that stands for its component."""
    found = components(close_links(distinct.select("_print"), radius)).select(F.col("node").alias("_print"), "root")
    return settle(distinct.join(found, "_print", "left").withColumn("root", F.coalesce("root", "_print")))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = RADIUS) -> DataFrame:
    """Each row's ``key``, its fingerprint (``_print``) and ``component_id``: the smallest key reachable over links
    between fingerprints at most ``radius`` bits apart.

    Empty and null texts have fingerprint zero and link like any other. Repeated rows and ties get the
    same component. A null key never becomes a component's id (unless all its keys are null). Equal
    fingerprints are one row before any hashing, so copies cost nothing more, however many there are.
    """
    path = fresh_path(docs.sparkSession, "fingerprints")
    fingerprints(docs, text, shingle, [key]).withColumnRenamed(key, "_key").write.parquet(path)
    printed = docs.sparkSession.read.parquet(path)
    distinct = rooted(settle(printed.groupBy("_print").agg(F.min("_key").alias("low"))), radius)
    lows = distinct.groupBy("root").agg(F.min("low").alias("component_id"))
    labels = distinct.join(lows, "root").select("_print", "component_id")
    return printed.join(labels, "_print").select(F.col("_key").alias(key), "_print", "component_id")


def without_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one document of each component of ``near_duplicates``: the one with the least key, null keys last.

    Rows with the same key and text are one document and stay or go together; of different texts with one key in
    one component, one stays. A null text is an empty one. Columns and values of what stays are as before.
    """
    content = F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    read = docs.select(F.col(f"`{key}`").alias("_key"), content.alias("_row"), F.col(f"`{text}`").alias("_text"))
    path = fresh_path(docs.sparkSession, "fingerprints")
    fingerprints(read, "_text", shingle, ["_key", "_row"]).write.parquet(path)
    printed = docs.sparkSession.read.parquet(path).withColumn("_place", F.struct(F.col("_key").isNull().alias("last"), "_key", "_row"))
    distinct = rooted(settle(printed.groupBy("_print").agg(F.min("_place").alias("low"), F.max("_place").alias("high"))), radius)
    keepers = distinct.groupBy("root").agg(F.min("low").alias("keeper"), F.max("high").alias("other")).filter("keeper <> other").select("root", "keeper")
    labels = distinct.join(keepers, "root").select("_print", "keeper")
    gone = printed.join(labels, "_print").filter("_place <> keeper").select("_key", "_row").distinct().alias("g")
    same = F.col(f"d.`{key}`").eqNullSafe(F.col("g._key")) & (F.xxhash64(F.coalesce(F.col(f"d.`{text}`"), F.lit(""))) == F.col("g._row"))
    return docs.alias("d").join(gone, same, "left_anti")
