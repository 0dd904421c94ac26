"""Substring dedup: paragraphs that repeat across documents, found by MinHash banding and verified by exact
Jaccard similarity, and passages inside paragraphs, found at cuts that depend on content only."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.linking import linked, shared_buckets
from gridloom.llm.text import MIXERS, MULTIPLY, Words, mixed, powers, slices, texts_of, tidy
from gridloom.session import fresh_path, noted

SHINGLE = 5
SIMILARITY = 0.8

# Words of a line that is compared as a paragraph, and of a passage.
PARAGRAPH_WORDS, PASSAGE_WORDS = 20, 20

# A passage begins at a word whose hash is the least among so many words to either side.
REACH = 6

# Bands of minima: two paragraphs at similarity 0.8 share one with a chance of 1 - (1 - 0.8 ** 4) ** 10 = 99.5 %, at
# similarity 0.4 with 23 %. Two bands together (8 minima) are shared by what is very much alike.
BANDS, ROWS = 10, 4

# A set of so many shingles or fewer goes with a member of a bucket as it is; of a larger one the least so many, which
# have fewer in common by SLACK (over four deviations) than the sets' similarity says with a chance of 1 in 100,000.
SAMPLE, SLACK = 256, 28

SLICE_BYTES = 1 << 20
PARAGRAPH, PASSAGE = 0, 1


class Hashed:
    """Word and shingle hashes of some texts (A-Z in lower case), and the lines their words are in."""

    def __init__(self, column: pa.Array) -> None:
        texts = texts_of(column).lowered()
        words = self.words = Words(texts)
        numbers, distinct = words.numbers()
        digest = xxhash.xxh64_intdigest
        self.hashes = np.array([digest(w) for w in distinct.to_pylist()], dtype=np.uint64)[numbers] if len(words) else np.zeros(0, np.uint64)
        n = len(words)
        self.text = np.repeat(np.arange(len(texts)), words.counts())
        # A shingle begins at each word; one that leaves its paragraph is not used.
        self.shingles = np.zeros(n, dtype=np.uint64)
        for k, p in enumerate(powers(SHINGLE)):
            self.shingles[: n - k] += self.hashes[k:] * p
        self.shingles = mixed(self.shingles)
        breaks = np.flatnonzero(texts.data == 0x0A)
        line = np.searchsorted(breaks, words.starts)
        new = np.ones(n, dtype=bool)
        new[1:] = (line[1:] != line[:-1]) | (self.text[1:] != self.text[:-1])
        self.first = np.flatnonzero(new)  # first word of each line with a word
        self.size = np.diff(np.append(self.first, n))

    def paragraphs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First word, number of words, hash and bands of the long lines."""
        long = self.size >= PARAGRAPH_WORDS
        first, size = self.first[long], self.size[long]
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        at = np.repeat(first, size) + inside
        starts = np.cumsum(size) - size
        if not len(first):
            return first, size, np.zeros(0, np.uint64), np.zeros((0, BANDS), np.uint64)
        unit = mixed(np.add.reduceat(self.hashes[at] * powers(int(size.max()))[inside], starts) ^ (size.astype(np.uint64) * MIXERS[1]))
        whole = inside <= np.repeat(size, size) - SHINGLE
        shingles, begin = self.shingles[at[whole]], np.cumsum(size - SHINGLE + 1) - (size - SHINGLE + 1)
        # A product with an odd number is another order of hashes that are well mixed already.
        minima = [np.minimum.reduceat(shingles * (mixed(seed) | np.uint64(1)), begin) for seed in powers(BANDS * ROWS + 1)[1:, None]]
        bands = [mixed(minima[b * ROWS] * MULTIPLY + sum(minima[b * ROWS + 1 : (b + 1) * ROWS]) + np.uint64(b)) for b in range(BANDS)]
        return first, size, unit, np.stack(bands, axis=1)

    def passages(self) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of the passages of PASSAGE_WORDS words that begin at cuts."""
        n = len(self.hashes)
        rank = self.hashes.copy()
        rank[: n - 1] += self.hashes[1:] * MULTIPLY
        rank = mixed(rank)
        cut = np.ones(n, dtype=bool)
        for k in range(1, min(REACH, n - 1) + 1):
            same = self.text[k:] == self.text[:-k]
            cut[:-k] &= ~(same & (rank[k:] < rank[:-k]))
            cut[k:] &= ~(same & (rank[:-k] <= rank[k:]))
        ends = self.words.text_bounds[1:][self.text] if n else np.zeros(0, np.int64)
        first = np.flatnonzero(cut & (np.arange(n) + PASSAGE_WORDS <= ends))
        if not len(first):
            return first, np.zeros(0, np.uint64)
        unit = (self.hashes[first[:, None] + np.arange(PASSAGE_WORDS)] * powers(PASSAGE_WORDS)).sum(axis=1, dtype=np.uint64)
        return first, mixed(unit)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def units(docs: DataFrame) -> DataFrame:
    """Paragraphs and passages of ``docs`` (``_key``, ``_row``, ``_text``): kind, first word ``at``, words ``n``, hash, bands."""
    schema = T.StructType([*docs.schema.fields[:2], *T.StructType.fromDDL("kind byte, at int, n int, unit long, bands array<bigint>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", SLICE_BYTES):
                hashed = Hashed(part.column("_text"))
                first, size, unit, bands = hashed.paragraphs()
                more, passage = hashed.passages()
                at = np.concatenate([first, more])
                owner = hashed.text[at]
                lists = np.concatenate([np.arange(len(first) + 1) * BANDS, np.full(len(more), len(first) * BANDS)])
                columns = [
                    part.column("_key").take(pa.array(owner)), part.column("_row").take(pa.array(owner)),
                    pa.array(np.repeat([PARAGRAPH, PASSAGE], [len(first), len(more)]), pa.int8()), pa.array(at - hashed.words.text_bounds[owner], pa.int32()),
                    pa.array(np.concatenate([size, np.full(len(more), PASSAGE_WORDS)]), pa.int32()), signed(np.concatenate([unit, passage])),
                    pa.ListArray.from_arrays(pa.array(lists, pa.int32()), signed(np.ascontiguousarray(bands).reshape(-1))),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(tidy(run), schema)


def contents(docs: DataFrame) -> DataFrame:
    """Shingle sets of wanted paragraphs: from ``_text`` and ``_wanted`` (their hash, first word and words). ``part`` is
    the least SAMPLE of them at 32 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", SLICE_BYTES):
                hashed = Hashed(part.column("_text"))
                names, sets, parts = [], [], []
                for begin, wanted in zip(hashed.words.text_bounds[:-1].tolist(), part.column("_wanted").to_pylist(), strict=True):
                    for w in wanted:
                        first = begin + w["at"]
                        names.append(w["unit"])
                        own = np.unique(hashed.shingles[first : first + w["n"] - SHINGLE + 1])
                        sets.append(own.view(np.int64))
                        parts.append((own[:SAMPLE] >> np.uint64(32)).astype(np.uint32).view(np.int32))
                columns = [pa.array(names, pa.int64()), pa.array(sets, pa.list_(pa.int64())), pa.array(parts, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, names=["unit", "shingles", "part"])

    return docs.select("_text", "_wanted").mapInArrow(tidy(run), "unit long, shingles array<bigint>, part array<int>")


def near(similarity: float) -> str:
    """Condition on two paragraphs ``p`` and ``m``: their sizes ``n``, and the common shingles of ``part``, which small sets
    have whole (one more, as two may have the same 32 bits) and large ones to the extent of the larger one's sample."""
    large = "greatest(m.n, p.n)"
    least = f"{similarity / (1 + similarity)} * (m.n + p.n) * least({SAMPLE}, {large}) / {large}"
    return f"least(m.n, p.n) >= {similarity} * {large} AND size(array_intersect(m.part, p.part)) + if({large} > {SAMPLE}, {SLACK}, 1) >= {least}"


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """Stretches of documents that another document keeps: ``_key``, ``_row`` (a hash that tells rows of one
    key apart), ``start`` and ``stop`` (words), ``class_id`` and ``kept_in`` (the key of the document that keeps it).

    A paragraph is a line of at least 20 words; two are alike if the Jaccard similarity of their five-word
    shingles is ``similarity`` or more, classes are the components of such links, and equal paragraphs are
    one before any comparison. A passage is 20 equal words anywhere in two documents, at places chosen by the words
    themselves; overlapping ones add up, so longer repeats are found nearly whole wherever they begin. Of
    each class the document with the least key keeps all, all others lose theirs.

    Null and empty texts have no stretch. Rows with equal keys are one document, which does not repeat itself; rows
    with a null key keep all. Columns of ``docs`` other than key and text are not looked at; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    read = docs.select(F.col(f"`{key}`").alias("_key"), F.hash(F.col(f"`{text}`")).alias("_row"), F.col(f"`{text}`").alias("_text"))
    path = fresh_path(spark, "paragraphs")
    units(read).write.parquet(path)
    found = spark.read.parquet(path)

    # Paragraphs: distinct ones, those that share a band, the content of these, and the links that hold.
    lines = found.filter(F.col("kind") == PARAGRAPH)
    known = lines.groupBy("unit").agg(F.first(F.struct("_key", "_row", "at", "n", "bands")).alias("f"), F.min("_key").alias("keeper"), F.max("_key").alias("last"))
    path = fresh_path(spark, "distinct")
    known.select("unit", "f.*", "keeper", "last").write.parquet(path)
    known = spark.read.parquet(path)
    bands = known.select(F.col("unit").alias("node"), F.lit(0).alias("pos"), F.posexplode("bands").alias("band", "bucket"))
    buckets = shared_buckets(bands.select("bucket", "node", "pos"))
    pair = F.xxhash64(F.get("bands", F.col("band")), F.get("bands", (F.col("band") + 1) % BANDS))
    deep = known.join(buckets.select(F.col("node").alias("unit")).distinct(), "unit", "left_semi")
    deep = deep.select(F.col("unit").alias("node"), F.lit(0).alias("pos"), "bands", F.posexplode("bands").alias("band", "_one")).select("node", "pos", pair.alias("bucket"))
    deep = shared_buckets(deep)
    wanted = buckets.select(F.col("node").alias("unit")).distinct()
    wanted = noted(wanted.join(known, "unit").groupBy("_key", "_row").agg(F.collect_list(F.struct("unit", "at", "n")).alias("_wanted")))
    same = F.col("d._key").eqNullSafe(F.col("w._key")) & (F.col("d._row") == F.col("w._row"))
    owners = read.alias("d").join(wanted.alias("w"), same).select("d.*", "_wanted").dropDuplicates(["_key", "_row"])
    sets = noted(contents(owners.select("_text", "_wanted")))

    def alike(pairs: DataFrame) -> DataFrame:
        sides = pairs.join(sets.select(F.col("unit").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("unit").alias("b"), F.col("shingles").alias("y")), "b")
        common = F.size(F.array_intersect("x", "y"))
        return sides.filter(common >= F.lit(similarity) * (F.size("x") + F.size("y") - common))

    facts = sets.select(F.col("unit").alias("node"), F.size("shingles").alias("n"), "part")
    sizes = f"least(m.n, p.n) >= {similarity} * greatest(m.n, p.n)"
    roots = linked([deep, buckets], facts, near(similarity), alike, noted(facts.select("node", "n")), sizes).select(F.col("node").alias("unit"), "root")
    classed = known.join(roots, "unit", "left").select("unit", F.coalesce("root", "unit").alias("class_id"), "keeper", "last")
    keepers = classed.groupBy("class_id").agg(F.min("keeper").alias("keeper"), F.max("last").alias("last")).filter("keeper <> last")
    line_classes = classed.select("unit", "class_id").join(keepers, "class_id").select("unit", "class_id", "keeper")

    # Passages: equal ones in more than one document.
    inner = found.filter(F.col("kind") == PASSAGE)
    shared = inner.groupBy("unit").agg(F.min("_key").alias("keeper"), F.max("_key").alias("last")).filter("keeper <> last")
    passage_classes = shared.select("unit", F.col("unit").alias("class_id"), "keeper")

    spot = ["_key", "_row", "at", "n", "unit"]
    hit = lines.select(*spot).join(line_classes, "unit").unionByName(inner.select(*spot).join(passage_classes, "unit"))
    return hit.filter("_key <> keeper").select("_key", "_row", F.col("at").alias("start"), (F.col("at") + F.col("n")).alias("stop"), "class_id", F.col("keeper").alias("kept_in"))


def stretches(found: DataFrame) -> DataFrame:
    """``repeats`` with the overlapping or touching stretches of a document joined; ``class_id`` and ``kept_in`` are
    those of the first of them. What one document has of them is gathered, nothing more."""
    spans = found.groupBy("_key", "_row").agg(F.sort_array(F.collect_set(F.struct("start", "stop", "class_id", "kept_in"))).alias("_spans"))
    schema = T.StructType([*spans.schema.fields[:2], *found.select("start", "stop", "class_id", "kept_in").schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {name: [] for name in schema.names}
            for key, row, listed in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                for span in union(listed):
                    for name, value in zip(schema.names, (key, row, span["start"], span["stop"], span["class_id"], span["kept_in"]), strict=True):
                        rows[name].append(value)
            types = {"_row": pa.int32(), "start": pa.int32(), "stop": pa.int32(), "class_id": pa.int64()}
            columns = [pa.array(v, types.get(k, batch.schema.field(0).type)) for k, v in rows.items()]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return spans.mapInArrow(tidy(run), schema)


def union(spans: list[dict]) -> list[dict]:
    out: list[dict] = []
    for span in spans:
        if out and span["start"] <= out[-1]["stop"]:
            out[-1]["stop"] = max(out[-1]["stop"], span["stop"])
        else:
            out.append(dict(span))
    return out


def without_words(text: str, spans: list[dict]) -> str:
    """A text without some runs of words and the white space after each."""
    raw = text.encode()
    words = Words(texts_of(pa.array([text])))
    starts, out, at = words.starts, [], 0
    for span in spans:
        out.append(raw[at : int(starts[span["start"]])])
        at = int(starts[span["stop"]]) if span["stop"] < len(starts) else len(raw)
    return b"".join([*out, raw[at:]]).decode()


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the stretches of ``repeats`` cut out of their texts, without the documents of which no word is
    left. Documents without a repeat stay as they are, empty and null texts too; columns and their order stay."""
    marks = repeats(docs, key, text).groupBy("_key", "_row").agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("_spans"))
    same = F.col(f"d.`{key}`").eqNullSafe(F.col("m._key")) & (F.hash(F.col(f"d.`{text}`")) == F.col("m._row"))
    joined = docs.alias("d").join(marks.alias("m"), same, "left").select(*[F.col(f"d.`{c}`").alias(f"_{i}") for i, c in enumerate(docs.columns)], F.col("m._spans").alias("_spans"))
    names = docs.columns
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, texts = batch.columns[-1].to_pylist(), batch.column(at).to_pylist()
            cut = [t if s is None else without_words(t, union(s)) for t, s in zip(texts, spans, strict=True)]
            columns = batch.columns[:-1]
            columns[at] = pa.array(cut, columns[at].type)
            kept = pa.array([s is None or bool(t.strip()) for t, s in zip(cut, spans, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(kept)

    return joined.mapInArrow(tidy(run), docs.schema)
