"""Token ids in binary files: blocks in patched frame-of-reference coding, with an index of block starts."""

from __future__ import annotations

import posixpath
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.text import slices, texts_of, tidy
from gridloom.llm.tokens import Encoder, with_end

# Fixed values of the file format.
MAGIC = b"GLPFOR01"
BLOCK = 128
HEADER = struct.Struct("<8sIIQQQ")  # magic, block size, blocks, ids, documents, bytes of payload
INDEX = np.dtype([("start", "<u8"), ("low", "<u4"), ("width", "u1"), ("exceptions", "u1"), ("pad", "<u2")])

# Share of a block's values that its width must hold, in hundredths.
PERCENTILE = 90

# Ids in a file, but for the last document.
FILE_IDS = 4_000_000
SLICE_BYTES = 4 << 20


def packed(values: np.ndarray, width: int) -> np.ndarray:
    """The lowest ``width`` bits of the values of each block one after another, as bytes; all blocks at once, place by place."""
    columns = np.ascontiguousarray(values.T).astype(np.uint64) & np.uint64((1 << width) - 1)
    words = np.zeros((BLOCK * width // 64, len(values)), dtype=np.uint64)
    for i, column in enumerate(columns):
        word, shift = divmod(i * width, 64)
        words[word] |= column << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= column >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).astype("<u8", copy=False).view(np.uint8)


def unpacked(raw: np.ndarray, width: int) -> np.ndarray:
    """The values of blocks of ``packed``."""
    words = np.ascontiguousarray(np.ascontiguousarray(raw).view("<u8").T)
    out, low = np.empty((BLOCK, len(raw)), dtype=np.uint32), np.uint64((1 << width) - 1)
    for i in range(BLOCK):
        word, shift = divmod(i * width, 64)
        values = words[word] >> np.uint64(shift)
        if shift + width > 64:
            values |= words[word + 1] << np.uint64(64 - shift)
        out[i] = values & low
    return out.T


def encode_blocks(ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Index and payload of ids. A block is its values less the minimum, packed at the width that holds
    PERCENTILE of them; larger ones are in a list of places (a byte each) and values (four bytes)."""
    n = -(-len(ids) // BLOCK)
    full = np.empty(n * BLOCK, dtype=np.uint32)
    full[: len(ids)] = ids
    if n:
        full[len(ids) :] = full[(n - 1) * BLOCK : len(ids)].min()
    blocks = full.reshape(n, BLOCK)
    low = blocks.min(axis=1) if n else np.zeros(0, np.uint32)
    delta = blocks - low[:, None]
    rank = -(-BLOCK * PERCENTILE // 100) - 1
    limit = np.partition(delta, rank, axis=1)[:, rank] if n else low
    width = np.where(limit > 0, np.floor(np.log2(np.maximum(limit, 1))) + 1, 0).astype(np.int64)
    large = delta >= (np.uint64(1) << width.astype(np.uint64))[:, None]
    exceptions = large.sum(axis=1)
    size = BLOCK // 8 * width + 5 * exceptions
    stops = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    payload = np.zeros(int(stops[-1]), dtype=np.uint8)
    for w in np.unique(width):
        if w:
            at = np.flatnonzero(width == w)
            payload[stops[at][:, None] + np.arange(BLOCK // 8 * w)] = packed(delta[at], int(w))
    block, place = np.nonzero(large)
    order = np.arange(len(block)) - np.searchsorted(block, block)
    after = stops[block] + BLOCK // 8 * width[block]
    payload[after + order] = place
    values = delta[block, place].astype("<u4").view(np.uint8).reshape(-1, 4)
    payload[(after + exceptions[block] + 4 * order)[:, None] + np.arange(4)] = values
    index = np.zeros(n, dtype=INDEX)
    index["start"], index["low"], index["width"], index["exceptions"] = stops[:-1], low, width, exceptions
    return index, payload.tobytes()


def decode_blocks(index: np.ndarray, payload: np.ndarray) -> np.ndarray:
    """The values of the blocks in ``index``; ``payload`` holds them from their ``start`` on."""
    n = len(index)
    out = np.zeros((n, BLOCK), dtype=np.uint32)
    start, width, exceptions = index["start"].astype(np.int64), index["width"].astype(np.int64), index["exceptions"].astype(np.int64)
    for w in np.unique(width):
        if w:
            at = np.flatnonzero(width == w)
            out[at] = unpacked(payload[start[at][:, None] + np.arange(BLOCK // 8 * w)], int(w))
    block = np.repeat(np.arange(n), exceptions)
    order = np.arange(len(block)) - np.searchsorted(block, block)
    after = start[block] + BLOCK // 8 * width[block]
    values = payload[(after + exceptions[block] + 4 * order)[:, None] + np.arange(4)]
    out[block, payload[after + order]] = np.ascontiguousarray(values).view("<u4").reshape(-1)
    return (out + index["low"][:, None]).reshape(-1)


def to_bytes(ids: np.ndarray, lengths: np.ndarray, keys: list[int | None]) -> bytes:
    """A file: header, index of block starts, payload, then key, null mark and length of each document."""
    index, payload = encode_blocks(ids)
    head = HEADER.pack(MAGIC, BLOCK, len(index), len(ids), len(lengths), len(payload))
    known = np.array([k or 0 for k in keys], dtype="<i8")
    missing = np.array([k is None for k in keys], dtype=np.uint8)
    return b"".join([head, index.tobytes(), payload, known.tobytes(), missing.tobytes(), lengths.astype("<u8").tobytes()])


class Reader:
    """A file of ``to_bytes``."""

    def __init__(self, raw: bytes) -> None:
        magic, block, blocks, self.n_ids, docs, size = HEADER.unpack_from(raw)
        if magic != MAGIC or block != BLOCK:
            raise ValueError("not a token file of this format")
        at = HEADER.size
        self.index = np.frombuffer(raw, INDEX, blocks, at)
        at += self.index.nbytes
        self.payload = np.frombuffer(raw, np.uint8, size, at)
        at += size
        keys, missing = np.frombuffer(raw, "<i8", docs, at), np.frombuffer(raw, np.uint8, docs, at + 8 * docs)
        self.lengths = np.frombuffer(raw, "<u8", docs, at + 9 * docs).astype(np.int64)
        self.keys = pa.array(keys, pa.int64(), mask=missing.astype(bool))

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids from ``start`` to ``stop``; only the blocks that hold them are decoded."""
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        first = start // BLOCK
        return decode_blocks(self.index[first : -(-stop // BLOCK)], self.payload)[start - first * BLOCK : stop - first * BLOCK]


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def _put(uri: str, name: str, raw: bytes, attempt: int) -> None:
    """Write a file under its name only when it is whole; a repeated task writes the same file again."""
    store, root = _store(uri)
    store.create_dir(root)
    last = posixpath.join(root, name)
    with store.open_output_stream(f"{last}.{attempt}.tmp") as out:
        out.write(raw)
    store.move(f"{last}.{attempt}.tmp", last)


def write_tokens(docs: DataFrame, uri: str, tokenizer: str, end_id: int = 1, key: str = "doc_id", text: str = "text") -> None:
    """Write the ids of all documents, each with ``end_id`` after it, in ascending order of ``key`` (a whole
    number) to files under ``uri``, a folder that driver and executors share.

    Rows with a null key come first; rows with equal keys are ordered by their text. A null or empty text
    is the end id alone. An empty table makes no file. Texts are range-partitioned by key, and each task
    writes its files in order; ``manifest`` lists partition, file number, documents and ids.
    """
    read = docs.select(F.col(f"`{key}`").cast("long").alias("_key"), F.col(f"`{text}`").alias("_text"))
    order = ["_key", F.xxhash64("_text"), "_text"]
    ranged = read.repartitionByRange(*order[:2]).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, encoder = TaskContext.get(), Encoder.of(tokenizer)
        part, made = context.partitionId(), 0
        parts: list[tuple[np.ndarray, np.ndarray, list]] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal made, held
            ids, lengths = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
            name = f"part-{part:06d}-{made:06d}.pfor"
            _put(uri, name, to_bytes(ids, lengths, [k for p in parts for k in p[2]]), context.taskAttemptId())
            row = pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "number": pa.array([made], pa.int32()), "name": [name],
                                              "n_docs": pa.array([len(lengths)], pa.int64()), "n_ids": pa.array([len(ids)], pa.int64())})
            parts.clear()
            made, held = made + 1, 0
            return row

        for batch in batches:
            for some in slices(batch, "_text", SLICE_BYTES):
                ids, bounds = with_end(*encoder.encode(texts_of(some.column("_text"))), end_id)
                parts.append((ids, np.diff(bounds), some.column("_key").to_pylist()))
                held += len(ids)
                if held >= FILE_IDS:
                    yield flush()
        if parts:
            yield flush()

    ranged.mapInArrow(tidy(run), "part int, number int, name string, n_docs long, n_ids long").write.parquet(f"{uri}/manifest")


def manifest(spark: SparkSession, uri: str) -> DataFrame:
    """The files under ``uri`` and the number of ids in all files before each.

    Ids are summed by partition first, so that the only ordered pass over all is over one row per partition.
    """
    files = spark.read.parquet(f"{uri}/manifest")
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("_parts"))
    inside = F.sum("n_ids").over(W.partitionBy("part").orderBy("number")) - F.col("n_ids")
    return files.withColumn("_inside", inside).join(parts, "part").select("part", "number", "name", "n_docs", "n_ids", (F.col("_inside") + F.col("_parts")).alias("base"))


def read_tokens(spark: SparkSession, uri: str, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """The documents of the files under ``uri``: key, ``start`` (ids of all documents before), ``n_tokens``,
    ``ids_crc32`` (of the ids as little-endian unsigned 32-bit numbers) and the ids if asked for."""
    files = manifest(spark, uri)
    n = max(1, min(files.count(), 20_000))
    schema = T.StructType.fromDDL("_key long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else ""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(uri)
        for batch in batches:
            for name, base in zip(batch.column("name").to_pylist(), batch.column("base").to_pylist(), strict=True):
                with store.open_input_file(posixpath.join(root, name)) as file:
                    reader = Reader(file.read())
                ids = reader.ids()
                bounds = np.concatenate([[0], np.cumsum(reader.lengths)])
                view = memoryview(np.ascontiguousarray(ids, dtype="<u4")).cast("B")
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                columns = [reader.keys, pa.array(base + bounds[:-1]), pa.array(reader.lengths), pa.array(crc, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return files.select("name", "base").repartition(n, "name").mapInArrow(tidy(run), schema).withColumnRenamed("_key", key)
