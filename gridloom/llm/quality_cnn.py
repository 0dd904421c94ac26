"""Quality classifier: a byte-level convolutional network in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.text import Texts, carried, slices, texts_of, tidy

# Bytes a filter sees, filters, hidden units, bytes by which overlapping chunks of two blocks advance.
WIDTH, FILTERS, HIDDEN, BLOCK = 5, 24, 16, 128

# Bounds of the training sample: labelled rows, and the bytes of a text that may be in it.
SAMPLE_ROWS, SAMPLE_BYTES = 2_000, 65_536

EPOCHS, BATCH, RATE, SEED = 14, 32, 0.004, 7

SLICE_BYTES = 256 << 10

# Bytes of a text whose filter outputs are in memory at once when texts are scored.
PIECE = 96 << 10


class Network:
    """Filters over one-hot bytes, maxima over overlapping chunks that cover the whole text, a hidden layer
    per chunk, mean and maximum of it over the chunks, and one logistic unit."""

    def __init__(self, seed: int = SEED) -> None:
        draw = np.random.default_rng(seed)
        self.filters = draw.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.w1 = draw.normal(0, FILTERS**-0.5, (FILTERS, HIDDEN)).astype(np.float32)
        self.b1 = np.zeros(HIDDEN, np.float32)
        self.w2 = draw.normal(0, HIDDEN**-0.5, 2 * HIDDEN).astype(np.float32)
        self.b2 = np.zeros(1, np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.filters, self.bias, self.w1, self.b1, self.w2, self.b2]

    def signal(self, data: np.ndarray) -> np.ndarray:
        """The filters' outputs at every window of some bytes."""
        windows = len(data) - WIDTH + 1
        out = np.zeros((windows, FILTERS), dtype=np.float32)
        for k in range(WIDTH):
            out += self.filters[k][data[k : k + windows]]
        return out

    def maxima(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """The largest output of each filter in every block; the outputs of PIECE bytes are in memory at once."""
        blocks = np.zeros((len(start), FILTERS), dtype=np.float32)
        at = 0
        while at < len(start):
            to = max(at + 1, int(np.searchsorted(stop, start[at] + PIECE, "right")))
            edges = np.stack([start[at:to], stop[at:to]], axis=1).reshape(-1) - start[at]
            signal = self.signal(data[start[at] : stop[to - 1] + WIDTH])
            blocks[at:to] = np.maximum.reduceat(signal, np.minimum(edges, len(signal) - 1), axis=0)[::2]
            at = to
        return blocks

    def forward(self, texts: Texts, trains: bool = False) -> dict[str, np.ndarray]:
        """All layers for some texts, with the filters' outputs if they are needed to train. Each text is followed by WIDTH
        zero bytes, so an empty one has a block too."""
        n = len(texts)
        sizes = np.diff(texts.bounds)
        begin = texts.bounds[:-1] + WIDTH * np.arange(n)
        data = np.zeros(len(texts.data) + WIDTH * n, dtype=np.uint8)
        for to, low, high in zip(begin.tolist(), texts.bounds[:-1].tolist(), texts.bounds[1:].tolist(), strict=True):
            data[to : to + high - low] = texts.data[low:high]
        # Windows that begin in the text (or at its first zero) belong to it.
        count = np.maximum(1, -(-sizes // BLOCK))
        first = np.concatenate([[0], np.cumsum(count)])
        inside = np.arange(first[-1]) - np.repeat(first[:-1], count)
        start = np.repeat(begin, count) + BLOCK * inside
        stop = np.minimum(start + BLOCK, np.repeat(begin + np.maximum(sizes, 1), count))
        blocks = self.maxima(data, start, stop)
        # A chunk is a block and the next one of the text; the last block stands alone.
        following = np.arange(len(blocks)) + (inside + 1 < np.repeat(count, count))
        pooled = np.maximum(blocks, blocks[following]) + self.bias
        active = np.maximum(pooled, 0)
        hidden = np.maximum(active @ self.w1 + self.b1, 0)
        mean = np.add.reduceat(hidden, first[:-1], axis=0) / count[:, None] if n else hidden[:0]
        high = np.maximum.reduceat(hidden, first[:-1], axis=0) if n else hidden[:0]
        joined = np.concatenate([mean, high], axis=1)
        chance = 1 / (1 + np.exp(-np.clip(joined @ self.w2 + self.b2, -30, 30)))
        signal = self.signal(data) if trains and n else np.zeros((0, FILTERS), np.float32)
        return {"data": data, "signal": signal, "start": start, "stop": stop, "blocks": blocks, "following": following, "active": active, "hidden": hidden,
                "count": count, "first": first, "high": high, "joined": joined, "chance": chance}

    def gradients(self, texts: Texts, labels: np.ndarray) -> list[np.ndarray]:
        x = self.forward(texts, trains=True)
        slope = ((x["chance"] - labels) / len(labels)).astype(np.float32)
        to_joined = slope[:, None] * self.w2
        owner = np.repeat(np.arange(len(labels)), x["count"])
        top = x["hidden"] == x["high"][owner]
        ties = np.add.reduceat(top, x["first"][:-1], axis=0, dtype=np.float32)
        to_hidden = to_joined[owner, :HIDDEN] / x["count"][owner, None] + top * to_joined[owner, HIDDEN:] / ties[owner]
        to_hidden = to_hidden * (x["hidden"] > 0)
        to_pooled = (to_hidden @ self.w1.T) * (x["active"] > 0)
        # The maximum of a chunk lies in one of its blocks, and there at one window.
        from_next = x["blocks"][x["following"]] > x["blocks"]
        to_block = np.where(from_next, 0, to_pooled)
        np.add.at(to_block, x["following"], np.where(from_next, to_pooled, 0))
        filters = np.zeros_like(self.filters)
        used = np.flatnonzero((to_block != 0).any(axis=1))
        places = np.stack([a + x["signal"][a:b].argmax(axis=0) for a, b in zip(x["start"][used].tolist(), x["stop"][used].tolist(), strict=True)]) if len(used) else np.zeros((0, FILTERS), int)
        flat = np.arange(FILTERS)[None, :]
        for k in range(WIDTH):
            at = x["data"][places + k].astype(np.int64) * FILTERS + flat
            filters[k] = np.bincount(at.reshape(-1), weights=to_block[used].reshape(-1), minlength=256 * FILTERS).reshape(256, FILTERS)
        return [filters, to_pooled.sum(axis=0), x["active"].T @ to_hidden, to_hidden.sum(axis=0), slope @ x["joined"], slope.sum(keepdims=True)]

    def train(self, texts: list[bytes], labels: np.ndarray) -> Network:
        """Adam on the log loss, in an order drawn from the seed."""
        draw = np.random.default_rng(SEED)
        own = self.parameters()
        first, second, step = [np.zeros_like(p) for p in own], [np.zeros_like(p) for p in own], 0
        for epoch in range(EPOCHS if len(texts) else 0):
            order = draw.permutation(len(texts))
            rate = RATE * (1 - epoch / EPOCHS)
            for i in range(0, len(order), BATCH):
                some = order[i : i + BATCH]
                step += 1
                for p, a, b, g in zip(own, first, second, self.gradients(joined([texts[k] for k in some]), labels[some]), strict=True):
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-7)
        return self


def joined(texts: list[bytes]) -> Texts:
    return Texts(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64))


def fit(docs: DataFrame, labels: DataFrame, learns: Column, key: str = "doc_id", text: str = "text", label: str = "quality", rows: int = SAMPLE_ROWS) -> Network:
    """A network trained on the driver with at most ``rows`` labelled rows (those with the least hash of their key)
    where ``learns``, a condition on the key in ``labels``, is true. Texts of over SAMPLE_BYTES bytes are
    not in the sample; no text is shortened. Rows without a label or a text are not in it either. With
    no rows at all the network stays as drawn."""
    chosen = labels.filter(learns).filter(F.col(f"`{label}`").isNotNull() & F.col(f"`{key}`").isNotNull())
    chosen = chosen.groupBy(F.col(f"`{key}`").alias("_key")).agg(F.min(f"`{label}`").alias("_label")).orderBy(F.xxhash64("_key"), "_key").limit(rows)
    texts = docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")).filter(F.octet_length("_text") <= SAMPLE_BYTES)
    found = texts.join(F.broadcast(chosen), "_key").orderBy(F.xxhash64("_key"), "_key", "_text").limit(rows).collect()
    return Network().train([r["_text"].encode() for r in found], np.array([float(r["_label"]) for r in found], dtype=np.float32))


def score(docs: DataFrame, network: Network, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all) of ``docs`` and ``score``, the chance that a text's quality is 1.

    Every byte of a text is seen, PIECE bytes at a time. Null is empty; an empty text is scored as one block of padding. Equal texts
    score the same, whatever their other columns; a column ``score`` in ``docs`` is replaced.
    """
    keep = [c for c in (keep or docs.columns) if c != "score"]
    read, fields = carried(docs, keep, F.col(f"`{text}`"))
    schema = T.StructType([*fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, len(keep), SLICE_BYTES):
                chance = network.forward(texts_of(part.column(len(keep))))["chance"].astype(np.float64)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(chance)], names=schema.names)

    return read.mapInArrow(tidy(run), schema)
