"""Pattern packing of documents into sequences: few-document length patterns, fitted to the length
histogram by non-negative least squares, rounded, and the residuals packed best fit first."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.text import slices, texts_of, tidy
from gridloom.llm.tokens import Encoder, with_end
from gridloom.session import fresh_path

SLICE_BYTES = 4 << 20
STEPS = 400


def patterns(most: int) -> np.ndarray:
    """All sets of up to three lengths that fill ``most`` exactly, one a row, longest first; 0 is no length."""
    rows = [np.array([[most, 0, 0]])]
    a = np.arange((most + 1) // 2, most)
    rows.append(np.stack([a, most - a, np.zeros_like(a)], axis=1))
    for first in range((most + 2) // 3, most - 1):
        b = np.arange((most - first + 1) // 2, min(first, most - first - 1) + 1)
        rows.append(np.stack([np.full_like(b, first), b, most - first - b], axis=1))
    return np.concatenate(rows)


def fit(histogram: np.ndarray, made: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Repeat counts x >= 0 of the patterns with least sum of squares of weight * (histogram - used lengths).

    Short lengths weigh less: what is left of them fits into any gap. Accelerated projected gradient.
    """
    most = len(histogram) - 1
    weight = 0.1 + 0.9 * np.arange(most + 1) / most
    weight[0] = 0
    scale = max(1.0, float(histogram.max()))
    target = histogram / scale

    def used(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(made[:, k], weights=x, minlength=most + 1) for k in range(made.shape[1]))

    def slope(residual: np.ndarray) -> np.ndarray:
        return (weight**2 * residual)[made].sum(axis=1)

    v = np.ones(len(made))
    for _ in range(20):
        v = slope(used(v))
        norm = np.linalg.norm(v)
        v /= norm
    x = y = np.zeros(len(made))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0, y - slope(used(y) - target) / (1.05 * norm))
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / after * (new - x)
        x, t = new, after
    return x * scale


def best_fit(left: dict[int, int], most: int) -> dict[tuple[int, ...], int]:
    """Best fit, longest first, of ``left[length]`` documents of each length; sequences with equal content
    are one entry with a count, so the work follows the number of lengths, not of documents."""
    bins: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)
    spaces: list[int] = []  # with at least one bin, ascending

    def put(space: int, content: tuple[int, ...], n: int) -> None:
        if space not in bins or not bins[space]:
            insort(spaces, space)
        bins[space][content] = bins[space].get(content, 0) + n

    for length in sorted(left, reverse=True):
        count = left[length]
        while count:
            k = bisect_left(spaces, length)
            if k == len(spaces):
                each = most // length
                if count >= each:
                    put(most - each * length, (length,) * each, count // each)
                if count % each:
                    put(most - count % each * length, (length,) * (count % each), 1)
                break
            space = spaces[k]
            content, n = bins[space].popitem()
            if not bins[space]:
                spaces.pop(k)
            taken = min(n, count)
            if n > taken:
                put(space, content, n - taken)
            put(space - length, (*content, length), taken)
            count -= taken
    done: dict[tuple[int, ...], int] = defaultdict(int)
    for by_content in bins.values():
        for content, n in by_content.items():
            done[content] += n
    return done


def plan(histogram: np.ndarray) -> dict[tuple[int, ...], int]:
    """How often each content (lengths in their order) is made; every document is in one of them."""
    most = len(histogram) - 1
    made = patterns(most)
    made = made[(histogram[made] > 0).all(axis=1) | ((made == 0) | (histogram[made] > 0)).all(axis=1)]
    left = histogram.copy()
    done: dict[tuple[int, ...], int] = defaultdict(int)
    if len(made):
        counts = np.rint(fit(histogram, made)).astype(np.int64)
        for k in np.argsort(-counts, kind="stable"):
            content = tuple(int(x) for x in made[k] if x)
            need = np.bincount(content, minlength=most + 1)
            lengths = list(set(content))
            n = min(int(counts[k]), int((left[lengths] // need[lengths]).min()))
            if counts[k] <= 0:
                break
            if n > 0:
                left[lengths] -= n * need[lengths]
                done[content] += n
    for content, n in best_fit({int(i): int(left[i]) for i in np.flatnonzero(left) if i}, most).items():
        done[content] += n
    return done


def slots(done: dict[tuple[int, ...], int]) -> np.ndarray:
    """Runs of documents of one length: length, first rank, first sequence, offset; sorted by length and rank."""
    ranks, runs, sequence = defaultdict(int), [], 0
    for content, n in sorted(done.items(), reverse=True):
        offset = 0
        for length in content:
            runs.append((length, ranks[length], sequence, offset))
            ranks[length] += n
            offset += length
        sequence += n
    return np.array(sorted(runs), dtype=np.int64).reshape(-1, 4)


def pieces(docs: DataFrame, tokenizer: str, end_id: int, most: int, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece of a document: key, piece, start, length, ids_crc32, its Spark partition, its rank
    among the pieces of its length there, and the ids if asked for."""
    read = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    more = [T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []
    schema = T.StructType([read.schema["_key"], *T.StructType.fromDDL("piece int, start long, length long, ids_crc32 long, part int, place long").fields, *more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = Encoder.of(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(most + 1, dtype=np.int64)
        for batch in batches:
            for some in slices(batch, "_text", SLICE_BYTES):
                ids, bounds = with_end(*encoder.encode(texts_of(some.column("_text"))), end_id)
                size = np.diff(bounds)
                n = -(-size // most)
                owner = np.repeat(np.arange(len(some)), n)
                piece = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                short = size - (n - 1) * most  # the first piece
                start = np.where(piece > 0, short[owner] + (piece - 1) * most, 0)
                length = np.where(piece > 0, most, short[owner])
                first = bounds[owner] + start
                view = memoryview(ids).cast("B")
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(first.tolist(), (first + length).tolist(), strict=True)]
                order = np.argsort(length, kind="stable")
                run_start = np.searchsorted(length[order], length[order])
                place = np.empty(len(length), dtype=np.int64)
                place[order] = np.arange(len(length)) - run_start + seen[length[order]]
                seen += np.bincount(length, minlength=most + 1)
                columns = [some.column("_key").take(pa.array(owner)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
                           pa.array(np.full(len(owner), part), pa.int32()), pa.array(place)]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(first, bounds[-1]), pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return read.mapInArrow(tidy(run), schema)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, most: int = 1024, key: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Every document placed in sequences of at most ``most`` tokens: one row per piece with the document's
    ``key``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and ``offset`` (and ``ids``).

    A document is its ids and ``end_id``. Only longer ones are cut, from their end into pieces of ``most``;
    the first piece is the rest. A null or empty text is the end id alone. Rows with equal or null keys are
    packed one by one; an empty table gives an empty one; other columns of ``docs`` are not looked at.

    Tokens are computed once, into the shared folder. The driver gets the histogram (one count per length,
    ``most`` at most) and returns runs of ranks. A piece's rank among those of its length is its rank in its
    partition plus the counts of the partitions before, so no task sorts or holds a length's pieces.
    """
    spark = docs.sparkSession
    path = fresh_path(spark, "pieces")
    pieces(docs, tokenizer, end_id, most, key, text, with_ids).write.parquet(path)
    cut = spark.read.parquet(path)
    counts = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = np.zeros(most + 1, dtype=np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[row["length"]] = row["n"]
    runs = slots(plan(histogram))
    keys = (runs[:, 0] << 48) + runs[:, 1]
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    ahead = counts.withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    ranked = cut.join(ahead, ["length", "part"]).withColumn("_rank", F.shiftleft("length", 48) + F.col("place") + F.col("ahead"))
    out = ["_key", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    ranked = ranked.select(*out, "_rank")
    schema = T.StructType([*ranked.schema.fields[:-1], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("_rank").to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, rank, "right") - 1
            columns = [*batch.columns[:-1], pa.array(runs[at, 2] + rank - keys[at]), pa.array(runs[at, 3])]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return ranked.mapInArrow(tidy(place), schema).withColumnRenamed("_key", key)


def sequences(placed: DataFrame) -> DataFrame:
    """The sequences of ``pack(..., with_ids=True)``: their ids in order and the length of each piece."""
    inside = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    return placed.groupBy("sequence_id").agg(inside.alias("p")).select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.length").alias("lengths"))
