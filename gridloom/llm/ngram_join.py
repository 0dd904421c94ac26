"""Similarity join on word n-grams: rare-first prefixes with length, positional and suffix filters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.linking import linked, shared_buckets
from gridloom.llm.text import MULTIPLY, Words, mixed, powers, slices, texts_of, tidy
from gridloom.session import fresh_path, noted

SHINGLE = 5
PERCENT = 80

# Counters of the sketch that tells common shingles from rare ones; a task sends one byte array per BLOCK of them.
COUNTERS, BLOCK = 1 << 20, 1 << 14

# Ranges of hashes whose counts bound what two sets can have in common.
RANGES = 16

# Least bits of a parity sketch (one array element).
WORD = 64

# So many 64-bit hashes of wanted texts at most (8 MB) are sent to all executors, so that other texts are not shuffled; with
# more of them all texts are.
SENT_ROWS = 1 << 20

SLICE_BYTES = 1 << 20


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """The distinct shingles (64-bit hashes in order) of each text; fewer words than ``size`` are one shingle."""
    words = Words(texts_of(column).lowered())
    numbers, distinct = words.numbers()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(w) for w in distinct.to_pylist()], dtype=np.uint64)[numbers] if len(words) else np.zeros(0, np.uint64)
    n = len(hashes)
    whole = np.zeros(n, dtype=np.uint64)
    for k, p in enumerate(powers(size)):
        whole[: n - k] += hashes[k:] * p
    whole = mixed(whole)
    sets = []
    for a, b in zip(words.text_bounds[:-1].tolist(), words.text_bounds[1:].tolist(), strict=True):
        if b - a >= size:
            sets.append(np.unique(whole[a : b - size + 1]))
        else:
            short = (hashes[a:b] * powers(b - a)).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)
            sets.append(mixed(short) if b > a else np.zeros(0, np.uint64))
    return sets


def counter(shingles: np.ndarray) -> np.ndarray:
    """The counter of the sketch that a shingle belongs to: its highest bits."""
    return (shingles >> np.uint64(65 - COUNTERS.bit_length())).astype(np.int64)


def common_counts(docs: DataFrame, size: int) -> np.ndarray:
    """How many texts hold a shingle of each counter, over all rows: a table of one fixed size, whatever the input.

    Each task counts its own rows; the tables of the tasks are added up block by block on the executors.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(COUNTERS, dtype=np.int64)
        for batch in batches:
            for part in slices(batch, "_text", SLICE_BYTES):
                own = shingle_sets(part.column("_text"), size)
                table += np.bincount(counter(np.concatenate(own)), minlength=COUNTERS)
        yield from blocks({i: table[i * BLOCK : (i + 1) * BLOCK] for i in range(COUNTERS // BLOCK)})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, raw in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                sums[i] = sums.get(i, 0) + np.frombuffer(pa.decompress(raw, BLOCK * 8, "zstd"), dtype=np.int64)
        yield from blocks(sums)

    def blocks(tables: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        raw = [pa.compress(np.ascontiguousarray(x).tobytes(), "zstd", asbytes=True) for x in tables.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(tables), pa.int32()), pa.array(raw, pa.binary())], names=["block", "counts"])

    counted = docs.select("_text").mapInArrow(tidy(count), "block int, counts binary").repartition("block").mapInArrow(add, "block int, counts binary")
    out = np.zeros(COUNTERS, dtype=np.int64)
    for row in counted.toArrow().to_pylist():  # COUNTERS numbers in all
        out[row["block"] * BLOCK : (row["block"] + 1) * BLOCK] = np.frombuffer(pa.decompress(row["counts"], BLOCK * 8, "zstd"), dtype=np.int64)
    return out


def prefix_length(n: int, percent: int) -> int:
    """Two sets at ``percent`` or more share one of so many first elements of each, in any common order."""
    return n - (n * percent + 99) // 100 + 1


def parities(shingles: np.ndarray) -> np.ndarray:
    """A bit for each of at least as many classes of hashes (a power of two) as there are shingles: whether the set has an
    odd number of the class. So many bits as differ in two sketches, so many shingles at least are in one set only."""
    size = max(WORD, 1 << (len(shingles) - 1).bit_length()) if len(shingles) else WORD
    classes = (shingles >> np.uint64(8)) & np.uint64(size - 1)
    odd = np.bincount(classes.astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def prefixes(docs: DataFrame, keep: list[str], size: int, percent: int) -> DataFrame:
    """The columns ``keep`` of ``docs``, ``node`` (a hash of the shingle set of ``_text``, null for none), ``n`` (its size), ``prefix``
    (its rarest shingles, then by hash), ``ranges`` (how many of its shingles are in each range of hashes) and ``bits`` (``parities``)."""
    counts = common_counts(docs, size)
    # The counts themselves: with the input all counters rise, and a common shingle still stands out by its own count.
    rank = counts
    read = docs.select(*keep, "_text")
    schema = T.StructType([*read.schema.fields[:-1], *T.StructType.fromDDL("node long, n long, prefix array<bigint>, ranges array<int>, bits array<bigint>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", SLICE_BYTES):
                nodes, sizes, firsts, ranges, bits = [], [], [], [], []
                for own in shingle_sets(part.column("_text"), size):
                    n = len(own)
                    order = np.argsort(rank[counter(own)], kind="stable")
                    nodes.append(int(mixed((own * MULTIPLY).sum(dtype=np.uint64, keepdims=True) + np.uint64(n)).view(np.int64)[0]) if n else None)
                    sizes.append(n)
                    firsts.append(own[order[: prefix_length(n, percent)]].view(np.int64) if n else np.zeros(0, np.int64))
                    ranges.append(np.bincount((own % np.uint64(RANGES)).astype(np.int64), minlength=RANGES).astype(np.int32))
                    bits.append(parities(own))
                lists = [pa.array(firsts, pa.list_(pa.int64())), pa.array(ranges, pa.list_(pa.int32())), pa.array(bits, pa.list_(pa.int64()))]
                columns = [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), *lists]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *columns], names=schema.names)

    return read.mapInArrow(tidy(run), schema)


def whole_sets(docs: DataFrame, size: int) -> DataFrame:
    """``node`` and all shingles of its set, from ``node`` and ``_text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", SLICE_BYTES):
                sets = [x.view(np.int64) for x in shingle_sets(part.column("_text"), size)]
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])

    return docs.select("node", "_text").mapInArrow(tidy(run), "node long, shingles array<bigint>")


def filters(percent: int) -> str:
    """What two sets ``p`` and ``m`` that meet in a prefix must pass: the length filter; the positional filter (from the first
    common element on, so much can be common); the suffix filter (counts of hash ranges, which partition both
    sets, bound their difference)."""
    together, most = "(m.n + p.n)", "least(m.n - m.pos, p.n - p.pos)"
    apart = "aggregate(zip_with(m.ranges, p.ranges, (x, y) -> abs(x - y)), 0, (s, x) -> s + x)"
    return f"""100 * least(m.n, p.n) >= {percent} * greatest(m.n, p.n) AND {100 + percent} * ({most}) >= {percent} * {together}
      AND {100 + percent} * ({together} - {apart}) >= {2 * percent} * {together}"""


def parity_filter(percent: int) -> str:
    """What the sketches of two sets ``a`` and ``b`` that passed the length filter must pass; a longer one (by one doubling at
    most) is folded to the other's classes."""
    short, long = "if(size(a.bits) <= size(b.bits), a.bits, b.bits)", "if(size(a.bits) <= size(b.bits), b.bits, a.bits)"
    half = f"size({short})"
    folded = f"if(size(a.bits) = size(b.bits), b.bits, zip_with(slice({long}, 1, {half}), slice({long}, {half} + 1, {half}), (x, y) -> x ^ y))"
    apart = f"aggregate(zip_with({short}, {folded}, (x, y) -> bit_count(x ^ y)), 0, (s, x) -> s + x)"
    return f"{100 + percent} * (a.n + b.n - {apart}) >= {2 * percent} * (a.n + b.n)"


def similar(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Each row's key (``_key``), ``n_shingles`` (distinct shingles of ``size`` words, A-Z in lower case) and ``component_id``, the
    smallest key reachable over links: two rows link if 100 * common >= percent * all of their shingles.

    A text of fewer words is one shingle. Null texts and those without a word have none and link with nothing, so
    their component is their own key. Texts with equal sets are one node from the start, so copies cost nothing.
    Rows with one key but different texts are nodes of their own; null keys are the component's only if all
    its keys are null. An empty table gives an empty one; other columns of ``docs`` are not looked at.

    Sets are compared by 64-bit hashes. All rows are counted in a sketch of fixed size, which orders shingles from
    rare to common; the order decides the cost only, any order finds every pair.
    """
    spark = docs.sparkSession
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    read = docs.select(F.col(f"`{key}`").alias("_key"), F.xxhash64(whole).alias("_row"), whole.alias("_text"))
    path = fresh_path(spark, "prefixes")
    prefixes(read, ["_key", "_row"], size, percent).write.parquet(path)
    printed = spark.read.parquet(path)

    nodes = printed.filter("node IS NOT NULL").groupBy("node").agg(F.min(F.struct(F.col("_key").isNull().alias("last"), "_key", "_row")).alias("low"), F.first("n").alias("n"))
    nodes = noted(nodes.select("node", "n", "low._key", "low._row"))
    buckets = shared_buckets(printed.filter("node IS NOT NULL").select("node", F.posexplode("prefix").alias("pos", "bucket")))
    facts = printed.join(buckets.select("node").distinct(), "node", "left_semi").select("node", "n", "ranges", "bits")
    facts = noted(facts.dropDuplicates(["node"]))

    def alike(pairs: DataFrame) -> DataFrame:
        """Pairs are compared by their sketches, an eighth of a byte a shingle; the texts of those that pass, which are few, are read
        again, and no others."""
        sides = pairs.alias("pairs").join(facts.alias("a"), F.col("pairs.a") == F.col("a.node")).join(facts.alias("b"), F.col("pairs.b") == F.col("b.node"))
        pairs = noted(sides.filter(parity_filter(percent)).select("pairs.a", "pairs.b"))
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        wanted = noted(ends.join(nodes, "node").select("node", "_key", "_row"))
        same = F.col("d._key").eqNullSafe(F.col("w._key")) & (F.col("d._row") == F.col("w._row"))
        some = read
        if wanted.count() <= SENT_ROWS:
            some = read.join(F.broadcast(wanted.select("_row").distinct()), "_row", "left_semi").select(read.columns)
        owners = some.alias("d").join(wanted.alias("w"), same).select("node", "d._text").dropDuplicates(["node"])
        sets = noted(whole_sets(owners, size))
        sides = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
        common = F.size(F.array_intersect("x", "y"))
        return sides.filter(100 * common >= percent * (F.size("x") + F.size("y") - common))

    roots = linked([buckets], facts.select("node", "n", "ranges"), filters(percent), alike)
    classed = noted(nodes.join(roots, "node", "left").select("node", "_key", F.coalesce("root", "node").alias("root")))
    lows = classed.groupBy("root").agg(F.min("_key").alias("component_id"))
    labels = classed.join(lows, "root").select("node", "component_id")
    linked_rows = printed.filter("node IS NOT NULL").join(labels, "node").select("_key", F.col("n").alias("n_shingles"), "component_id")
    alone = printed.filter("node IS NULL").select("_key", F.col("n").alias("n_shingles"), F.col("_key").alias("component_id"))
    return linked_rows.unionByName(alone)
