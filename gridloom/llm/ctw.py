"""Context-tree weighting of bytes: code length of a text under binary-decomposed byte contexts, whose
Krichevsky-Trofimov estimates are mixed over all depths."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.text import Texts, Words, give_back, slices, texts_of, tidy
from gridloom.session import fresh_path

# Bytes of context.
DEPTH = 5

# A byte that no UTF-8 text has: it ends each text, and texts begin in its context.
END = 0xFF

SLICE_BYTES = 1 << 20

# Bytes of text whose distinct contexts and words one scoring task looks up.
GROUP_BYTES = 32 << 20

# Keys that the model is built from at once, but for the last two bytes of context they belong to.
CHUNK_KEYS = 500_000

# Rows of an Arrow batch: a group goes to Python in batches of a few megabytes, not as one.
BATCH_ROWS = 1_000

GRAM, WORD = 0, 1


def grams(texts: Texts, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """A key for every byte of the texts and each end: its context, nearest byte first, then the byte. And bounds."""
    counts = np.diff(texts.bounds)
    bounds = texts.bounds + np.arange(len(counts) + 1)
    out = np.full(len(texts.data) + (depth + 1) * len(counts), END, dtype=np.int64)
    at = np.arange(len(texts.data)) + np.repeat((depth + 1) * np.arange(len(counts)) + depth, counts)
    out[at] = texts.data
    coded = np.ones(len(out), dtype=bool)
    coded[(bounds[:-1] + depth * np.arange(len(counts)))[:, None] + np.arange(depth)] = False
    key = out[depth:].copy()
    for back in range(1, depth + 1):
        key |= out[depth - back : len(out) - back] << (8 * (depth - back + 1))
    return key[coded[depth:]], bounds


def log_gamma_half(n: np.ndarray) -> np.ndarray:
    """log Gamma(n + 1/2) for n >= 0."""
    x = n + 0.5 + 8
    value = (x - 0.5) * np.log(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    for k in range(8):
        value -= np.log(n + 0.5 + k)
    return value


def log_factorial(n: np.ndarray) -> np.ndarray:
    return log_gamma_half(n + 0.5)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability of that many zeros and ones under the Krichevsky-Trofimov estimator."""
    return log_gamma_half(zeros) + log_gamma_half(ones) - 1.1447298858494002 - log_factorial(zeros + ones)


class Tree:
    """The context tree of some keys with counts, from depth ``depth`` up to depth ``top``.

    ``keys`` are sorted and distinct, and all keys of a context of depth ``top`` are there.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, depth: int, top: int) -> None:
        self.depth, self.top = depth, top
        self.keys = {depth: keys}
        self.counts = {depth: counts.astype(np.float64)}
        self.up: dict[int, np.ndarray] = {}  # row of depth d + 1 -> row of depth d
        for d in range(depth - 1, top - 1, -1):
            below = self.keys[d + 1]
            shorter = (below >> 16 << 8) | (below & 0xFF)
            self.keys[d], self.up[d] = np.unique(shorter, return_inverse=True)
            self.counts[d] = np.bincount(self.up[d], weights=self.counts[d + 1], minlength=len(self.keys[d]))

    def bit(self, j: int):
        """For bit j of a byte, from the deepest level up: node of each row, totals, chance of a one, log of
        the block probability, and log of the product of the block probabilities below (None at the bottom)."""
        weighted = owner = None
        for d in range(self.depth, self.top - 1, -1):
            keys, counts = self.keys[d], self.counts[d]
            prefix = keys >> (8 - j)
            new = np.ones(len(keys), dtype=bool)
            new[1:] = prefix[1:] != prefix[:-1]
            first = np.flatnonzero(new)
            node = np.cumsum(new) - 1
            total = np.add.reduceat(counts, first)
            ones = np.add.reduceat(np.where(keys >> (7 - j) & 1, counts, 0.0), first)
            own = log_kt(total - ones, ones)
            below = None
            if weighted is not None:
                below = np.bincount(node[self.up[d][owner]], weights=weighted, minlength=len(first))
            yield d, node, first, total, (ones + 0.5) / (total + 1), own, below
            weighted = own if below is None else np.logaddexp(own, below) - np.log(2)
            owner = first

    def chances(self, j: int) -> tuple[np.ndarray, np.ndarray]:
        """Chance of a one for bit j in the context of each key, mixed from the bottom to depth ``top``, and
        whether any context down there has been seen."""
        chance = seen = None
        row = None
        for _d, node, _first, total, one, own, below in self.bit(j):
            row = np.arange(len(self.keys[self.depth])) if row is None else self.up[_d][row]
            at = node[row]
            if chance is None:
                chance, seen = one[at], total[at] > 0
            else:
                beta = np.exp(np.clip(own - below, -50, 50))[at]
                chance = np.where(seen, (beta * one[at] + chance) / (1 + beta), one[at])
                seen = seen | (total[at] > 0)
        return chance, seen


def node_number(keys: np.ndarray, j: int) -> np.ndarray:
    """Number of the node of bit j in the tree of a byte: 1 at its root."""
    return (1 << j) | ((keys & 0xFF) >> (8 - j))


def chunks(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted keys and counts in runs that never part a context of two bytes."""
    shift = 8 * (depth - 1)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0
    for batch in batches:
        keys, counts = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "n"))
        if size >= CHUNK_KEYS:
            whole = int(np.searchsorted(keys >> shift, held[-1][0][-1] >> shift, "right"))
            held.append((keys[:whole], counts[:whole]))
            if whole < len(keys):
                yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
                held, size, keys, counts = [], 0, keys[whole:], counts[whole:]
            else:
                continue
        held.append((keys, counts))
        size += len(keys)
    if size:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def upper_levels(model: DataFrame, depth: int) -> tuple[np.ndarray, ...]:
    """Weight, chance of a one and total of the nodes of depth 1 (by byte of context and node) and of depth 0.

    Their counts and the block probabilities of depth 2 are summed by Spark; at most 65,280 sums reach the driver.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, counts in chunks(batches, depth):
            tree = Tree(keys, counts, depth, 2)
            for j in range(8):
                for d, _node, first, total, one, own, below in tree.bit(j):
                    if d > 2:
                        continue
                    weighted = own if below is None else np.logaddexp(own, below) - np.log(2)
                    at = tree.keys[2][first]
                    number = (at >> 16) * 256 + node_number(at, j)
                    distinct, inverse = np.unique(number, return_inverse=True)
                    ones = np.rint(one * (total + 1) - 0.5)
                    values = [np.bincount(inverse, weights=x) for x in (total, ones, weighted)]
                    yield pa.RecordBatch.from_arrays([pa.array(distinct), *map(pa.array, values)], names=["node", "total", "ones", "weighted"])

    nodes = model.mapInArrow(tidy(sums), "node long, total double, ones double, weighted double")
    rows = nodes.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("total", "ones", "weighted")]).toPandas()
    total, ones, below = (np.zeros(256 * 256) for _ in range(3))
    at = rows["node"].to_numpy(dtype=np.int64)
    total[at], ones[at], below[at] = (rows[c].to_numpy(dtype=np.float64) for c in ("total", "ones", "weighted"))

    def level(total: np.ndarray, ones: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, ...]:
        own = log_kt(total - ones, ones)
        return np.exp(np.clip(own - below, -50, 50)), (ones + 0.5) / (total + 1), total, np.logaddexp(own, below) - np.log(2)

    *one_byte, weighted = level(total, ones, below)
    *no_byte, _ = level(*(x.reshape(256, 256).sum(axis=0) for x in (total, ones, weighted)))
    return (*one_byte, *no_byte)


def code_lengths(model: DataFrame, depth: int) -> DataFrame:
    """log10 of the probability of every key's byte in its context: ``kind``, ``key``, ``value``."""
    beta1, one1, total1, beta0, one0, total0 = upper_levels(model, depth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, counts in chunks(batches, depth):
            tree, value = Tree(keys, counts, depth, 2), np.zeros(len(keys))
            for j in range(8):
                chance, seen = tree.chances(j)
                low = node_number(keys, j)
                at = (keys >> (8 * depth)) * 256 + low
                chance = np.where(seen, (beta1[at] * one1[at] + chance) / (1 + beta1[at]), one1[at])
                seen = seen | (total1[at] > 0)
                chance = np.where(seen, (beta0[low] * one0[low] + chance) / (1 + beta0[low]), one0[low])
                value += np.log10(np.where(keys >> (7 - j) & 1, chance, 1 - chance))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), GRAM, np.int8)), pa.array(keys), pa.array(value)], names=["kind", "key", "value"])

    return model.mapInArrow(tidy(run), "kind byte, key long, value double")


def word_hashes(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """For every word the place of its hash in the second result."""
    numbers, distinct = words.numbers()
    digest = xxhash.xxh64_intdigest
    return numbers, np.array([digest(w) for w in distinct.to_pylist()], dtype=np.uint64).view(np.int64)


class Counts:
    """Counts by key. New ones are merged in as soon as they are as many as those that are there."""

    def __init__(self) -> None:
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.fresh: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.fresh.append((keys, counts.astype(np.int64)))
        self.waiting += len(keys)
        if self.waiting > max(200_000, len(self.keys) // 2):
            self.merge()

    def merge(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self.fresh)])
        counts = np.concatenate([self.counts, *(n for _, n in self.fresh)])
        self.fresh, self.waiting = [], 0
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        first = np.ones(len(keys), dtype=bool)
        first[1:] = keys[1:] != keys[:-1]
        first = np.flatnonzero(first)
        self.keys, self.counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts


def gathered(table: pa.Table, depth: int) -> Iterator[pa.RecordBatch]:
    """Distinct grams and words of one group of texts, with their counts in training texts (0 if in none)."""
    found = {GRAM: Counts(), WORD: Counts()}
    for batch in table.to_batches():
        for part in slices(batch, "_text", SLICE_BYTES):
            texts, trains = texts_of(part.column("_text")).lowered(), ~part.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            keys, bounds = grams(texts, depth)
            # The lowest bit of the sorted number is whether it is a training text's.
            both, times = np.unique(keys << 1 | np.repeat(trains, np.diff(bounds)), return_counts=True)
            found[GRAM].add(both >> 1, np.where(both & 1, times, 0))
            words = Words(texts)
            numbers, hashes = word_hashes(words)
            found[WORD].add(hashes, np.bincount(numbers, weights=np.repeat(trains, words.counts()), minlength=len(hashes)))
    group = table.column("_group")[0].as_py()
    for kind, held in found.items():
        held.merge()
        n = len(held.keys)
        columns = [pa.array(np.full(n, group, np.int32)), pa.array(np.full(n, kind, np.int8)), pa.array(held.keys), pa.array(held.counts)]
        yield pa.RecordBatch.from_arrays(columns, names=["_group", "kind", "key", "n"])


def scored(left: pa.Table, right: pa.Table, depth: int, n_tokens: int, n_ends: int, distinct: int) -> Iterator[pa.RecordBatch]:
    kinds, keys, values = (right.column(c).to_numpy() for c in ("kind", "key", "value"))
    tables = {}
    for kind in (GRAM, WORD):
        at = np.flatnonzero(kinds == kind)
        at = at[np.argsort(keys[at])]
        tables[kind] = keys[at], values[at]
    below = n_tokens + 0.5 * (distinct + 1)
    end = np.log10((n_ends + 0.5) / below)
    for batch in left.to_batches():
        for part in slices(batch, "_text", SLICE_BYTES):
            texts = texts_of(part.column("_text")).lowered()
            found, bounds = grams(texts, depth)
            known, chances = tables[GRAM]
            owner = np.repeat(np.arange(len(part)), np.diff(bounds))
            score = np.bincount(owner, weights=chances[np.searchsorted(known, found)], minlength=len(part))
            words = Words(texts)
            numbers, hashes = word_hashes(words)
            known, counts = tables[WORD]
            count = counts[np.searchsorted(known, hashes)] if len(hashes) else np.zeros(0)
            owner = np.repeat(np.arange(len(part)), words.counts())
            base = np.bincount(owner, weights=np.log10((count + 0.5) / below)[numbers], minlength=len(part)) + end
            seen = np.bincount(owner, weights=(count > 0)[numbers], minlength=len(part)).astype(np.int64) + (n_ends > 0)
            columns = [part.column("_key"), part.column("held_out"), pa.array(words.counts() + 1, pa.int64()), pa.array(seen), pa.array(np.full(len(part), n_tokens, np.int64)), pa.array(base), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=["_key", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if not 0 < int(before) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def context_tree_scores(docs: DataFrame, held_out, key: str = "doc_id", text: str = "text", depth: int = DEPTH) -> DataFrame:
    """For every row of ``docs``: key, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    Texts are lower-cased (A-Z). ``score`` is log10 of the probability of the text's bytes and of its end under a
    context tree learnt from all rows where ``held_out`` is not true: each byte is eight decisions, each in the
    contexts of 0 to ``depth`` bytes; a node's Krichevsky-Trofimov estimate and what lies below it are mixed by
    their block probabilities on the training texts, and contexts without counts are left out. The base score is
    that of word counts with one half added. A null or empty text is its end alone. Equal rows score the
    same; a null ``held_out`` counts as not held out; an empty table gives an empty table.

    Texts are dealt into groups of about 32 MB by a hash. A task cuts a group down to its distinct grams and
    words, so that what is shuffled are those. Their counts are added up by key; the tree is built where
    all contexts that share their last two bytes meet (distinct grams only, not occurrences); each
    group gets back the values of its own grams and words, never the whole model. Groups reach Python in Arrow
    batches of at most BATCH_ROWS rows; the session's setting is as before when the scores are written.
    """
    spark = docs.sparkSession
    with small_batches(spark):
        return _written_scores(docs, held_out, key, text, depth)


def _written_scores(docs: DataFrame, held_out, key: str, text: str, depth: int) -> DataFrame:
    spark = docs.sparkSession
    read = docs.select(F.col(f"`{key}`").alias("_key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    size = read.agg(F.sum(F.octet_length("_text")).alias("bytes"), F.count_if(~F.col("held_out")).alias("ends")).first()
    n_groups = max(1, -(-(size["bytes"] or 0) // GROUP_BYTES))
    grouped = read.withColumn("_group", F.pmod(F.xxhash64("_key", "_text"), F.lit(n_groups)).cast("int"))
    path = fresh_path(spark, "grams")

    def count(table: pa.Table) -> pa.Table:
        give_back()
        return pa.Table.from_batches(gathered(table, depth))

    rows = grouped.groupBy("_group").applyInArrow(count, "_group int, kind byte, key long, n long")
    rows.write.parquet(f"{path}/groups")
    rows = spark.read.parquet(f"{path}/groups")
    rows.groupBy("kind", "key").agg(F.sum("n").alias("n")).write.parquet(f"{path}/counts")
    counts = spark.read.parquet(f"{path}/counts")
    told = counts.filter(F.col("kind") == WORD)
    tokens = told.agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("v")).first()
    n_ends, n_tokens, distinct = size["ends"], (tokens["n"] or 0) + size["ends"], tokens["v"] + (size["ends"] > 0)
    model = counts.filter(F.col("kind") == GRAM).select("key", "n")
    model = model.repartition(F.shiftright("key", 8 * (depth - 1))).sortWithinPartitions("key")
    values = code_lengths(model, depth).union(told.select("kind", "key", F.col("n").cast("double")))
    looked = rows.select("_group", "kind", "key").join(values, ["kind", "key"])
    schema = T.StructType([read.schema["_key"], *T.StructType.fromDDL("held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double").fields])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        give_back()
        return pa.Table.from_batches(list(scored(left, right, depth, n_tokens, n_ends, distinct)))

    grouped.groupBy("_group").cogroup(looked.groupBy("_group")).applyInArrow(run, schema).write.parquet(f"{path}/scores")
    return spark.read.schema(schema).parquet(f"{path}/scores").withColumnRenamed("_key", key)


def told_apart(key: str, parts: int, held: int):
    """Whether the CRC-32 of a key as text has the remainder ``held``."""
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % parts == held, F.lit(False))
