"""Whole-column text work on Arrow buffers: word bounds, word numbers and slices of bounded size."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

# The bytes that end a word (space, tab, line feed, vertical tab, form feed, carriage return).
WHITE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

# Odd multipliers; any would do, all runs need the same.
MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
MIXERS = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

IS_WHITE = np.zeros(256, dtype=bool)
IS_WHITE[list(WHITE)] = True


class Texts:
    """UTF-8 bytes of some texts, one after another; text i is ``data[bounds[i]:bounds[i + 1]]``. Null is empty."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray) -> None:
        self.data, self.bounds = data, bounds

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def raw(self, i: int) -> bytes:
        return self.data[self.bounds[i] : self.bounds[i + 1]].tobytes()

    def lowered(self) -> Texts:
        """A-Z in lower case; other letters stay."""
        upper = (self.data >= 65) & (self.data <= 90)
        return Texts(self.data | (upper.astype(np.uint8) << 5), self.bounds)


def texts_of(column: pa.Array) -> Texts:
    """The bytes of a string column without a copy of them."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return Texts(raw[bounds[0] : bounds[-1]], bounds - bounds[0])


def slices(batch: pa.RecordBatch, column: str | int, size: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``size`` bytes of text each (a longer text is a part of its own)."""
    bounds = texts_of(batch.column(column)).bounds
    at = 0
    while at < len(batch):
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + size, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def carried(docs: DataFrame, keep: list[str], last: Column) -> tuple[DataFrame, list[StructField]]:
    """The columns ``keep`` of ``docs`` under names of their own and ``last`` after them, so that no name clashes on the way
    through a function on Arrow batches; and the fields that the columns had."""
    plain = docs.select(*[F.col(f"`{c}`") for c in keep]).schema.fields
    return docs.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(keep)], last.alias("_last")), plain


class Words:
    """Words of several texts: their bytes without white space, bounds in those bytes, and first word per text."""

    def __init__(self, texts: Texts) -> None:
        data, bounds = texts.data, texts.bounds
        solid = ~IS_WHITE[data]
        first, last = solid.copy(), solid.copy()
        if len(data):
            first[1:] &= ~solid[:-1]
            last[:-1] &= ~solid[1:]
            inner = bounds[:-1][(bounds[:-1] < len(data)) & (bounds[1:] > bounds[:-1])]
            first[inner] |= solid[inner]
            inner = inner[inner > 0]
            last[inner - 1] |= solid[inner - 1]
        starts = np.flatnonzero(first)
        lengths = np.flatnonzero(last) + 1 - starts
        self.starts = starts  # in the bytes of the texts
        self.lengths = lengths
        self.solid = data[solid]
        self.bounds = np.concatenate([[0], np.cumsum(lengths)])
        self.text_bounds = np.searchsorted(starts, bounds)  # first word of each text, and the number of words

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.text_bounds)

    def numbers(self) -> tuple[np.ndarray, pa.Array]:
        """A number for each word (equal words, equal numbers) and the distinct words."""
        return numbered(self.solid, self.bounds)

    def joined(self) -> tuple[bytes, np.ndarray]:
        """All words with one space after each, and the start of each word therein."""
        starts = self.bounds[:-1] + np.arange(len(self))
        out = np.full(len(self.solid) + len(self), 0x20, dtype=np.uint8)
        put = np.ones(len(out), dtype=bool)
        put[starts + self.lengths] = False
        out[put] = self.solid
        return out.tobytes(), starts


def numbered(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Numbers for the byte strings between ``bounds``, and the distinct strings."""
    if len(bounds) < 2:
        return np.zeros(0, np.int32), pa.array([], pa.binary())
    offsets = pa.py_buffer(np.ascontiguousarray(bounds, dtype=np.int64))
    array = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, offsets, pa.py_buffer(np.ascontiguousarray(data))])
    encoded = array.dictionary_encode()
    return encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary


def give_back() -> None:
    """Return freed memory to the system: a Python worker that waits for its next task would keep its peak."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` over batches, with memory given back after each and at the end."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            del batch
            give_back()

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(each(batches))
        give_back()

    return tidied


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIXERS[0]
    x = (x ^ (x >> np.uint64(27))) * MIXERS[1]
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.full(n, MULTIPLY, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out) if n else out
