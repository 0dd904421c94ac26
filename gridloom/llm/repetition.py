"""Quality rules on repetition: maximal repeated substrings of words from a suffix array and its
longest common prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.text import Texts, Words, carried, slices, texts_of, tidy

# Characters counted as symbols.
SYMBOLS = b"#*$%&|<>"

# Repeats of at least so many words count.
MIN_REPEAT = 8

# A text of fewer words fails.
MIN_WORDS = 20

# Largest share of words inside repeats, in hundredths.
MAX_COVERED = 30

# Longest repeat: at most this share of the words, in hundredths, where it has at least LONG_REPEAT words.
MAX_LONGEST = 15
LONG_REPEAT = 24

SLICE_BYTES = 1 << 20

RULES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, longest_repeat long, "
    "covered_chars long, spans array<struct<start:long,stop:long>>, base_failed boolean, kept boolean"
)


def repeat_lengths(numbers: np.ndarray, text_bounds: np.ndarray, least: int = MIN_REPEAT) -> np.ndarray:
    """For each word, the length in words of the longest substring that starts there and occurs elsewhere
    in the same text, where that is at least ``least`` (a power of two); 0 for all other words.

    Suffixes are ranked by prefix doubling; only those still tied with another are sorted on. The
    longest common prefix of neighbours in the suffix array is read off the ranks of all doublings.
    """
    n = len(numbers)
    found = np.zeros(n, dtype=np.int64)
    if not n:
        return found
    counts = np.diff(text_bounds)
    text = np.repeat(np.arange(len(counts)), counts)
    stop = np.repeat(text_bounds[1:], counts)
    levels = [numbers.astype(np.int64) + 1]
    k = 1
    at = np.arange(n)
    # The first sort orders by text and two words at once.
    base = int(levels[0].max()) + 1
    rank = text * base + levels[0]
    width, first = base, True
    while len(at):
        after = at + k
        ahead = np.zeros(len(at), dtype=np.int64)
        inside = after < stop[at]
        ahead[inside] = levels[-1][after[inside]] + (0 if first else 1)
        key = rank[at] * width + ahead
        order = np.argsort(key)
        key, at = key[order], at[order]
        fresh = np.ones(len(at), dtype=bool)
        fresh[1:] = key[1:] != key[:-1]
        group = np.flatnonzero(fresh)
        size = np.diff(np.append(group, len(at)))
        of = np.cumsum(fresh) - 1
        if first:
            rank = np.empty(n, dtype=np.int64)
            rank[at] = group[of]
        else:
            old = rank[at]
            start = np.ones(len(at), dtype=bool)
            start[1:] = old[1:] != old[:-1]
            begin = np.flatnonzero(start)[np.cumsum(start) - 1]
            rank = rank.copy()
            rank[at] = old + group[of] - begin
        levels.append(rank)
        width, first = n + 1, False
        k *= 2
        at = at[size[of] > 1]
        if k <= least:
            repeated = at
    # Suffixes with a repeated window of `least` words, in suffix order: neighbours share the longest prefix.
    if not len(repeated):
        return found
    order = repeated[np.argsort(levels[-1][repeated])]
    a, b = order[:-1].copy(), order[1:].copy()
    common = np.zeros(len(a), dtype=np.int64)
    same_text, end_a, end_b = text[a] == text[b], stop[a], stop[b]
    for level in range(len(levels) - 1, -1, -1):
        step = 1 << level
        ok = np.flatnonzero(same_text & (a + step <= end_a) & (b + step <= end_b))
        ok = ok[levels[level][a[ok]] == levels[level][b[ok]]]
        for moved in (common, a, b):
            moved[ok] += step
    common[common < least] = 0
    best = np.zeros(len(order), dtype=np.int64)
    best[:-1] = common
    best[1:] = np.maximum(best[1:], common)
    found[order] = best
    return found


def covered(lengths: np.ndarray) -> np.ndarray:
    """Which words lie inside a repeat: the union of the spans [i, i + lengths[i])."""
    edges = np.zeros(len(lengths) + 1, dtype=np.int64)
    at = np.flatnonzero(lengths)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + lengths[at], -1)
    return np.cumsum(edges[:-1]) > 0


def line_and_symbol_counts(texts: Texts) -> tuple[list[int], list[int]]:
    """Symbols, and lines with a word that equal an earlier line, of each text."""
    symbols, repeated = [], []
    for i in range(len(texts)):
        raw = texts.raw(i)
        symbols.append(len(raw) - len(raw.translate(None, SYMBOLS)))
        solid = [line for line in raw.split(b"\n") if line.strip()]
        repeated.append(len(solid) - len(set(solid)))
    return symbols, repeated


def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def judge(column: pa.Array) -> dict[str, pa.Array]:
    """The rule columns of some texts."""
    texts = texts_of(column)
    words = Words(texts)
    numbers, _ = words.numbers()
    lengths = repeat_lengths(numbers, words.text_bounds)
    inside = covered(lengths)
    points = np.add.reduceat((words.solid & 0xC0) != 0x80, words.bounds[:-1]).astype(np.int64) if len(words) else np.zeros(0, np.int64)
    n_words = words.counts().astype(np.int64)
    repeat_words = per_text(inside, words.text_bounds)
    covered_chars = per_text(np.where(inside, points, 0), words.text_bounds)
    longest = np.zeros(len(texts), dtype=np.int64)
    np.maximum.at(longest, np.repeat(np.arange(len(texts)), n_words), lengths)
    symbols, lines = line_and_symbol_counts(texts)
    # Spans of the repeats, in words of their text; the bounds of texts part them.
    padded = np.concatenate([[False], inside, [False]])
    new_text = np.zeros(len(inside) + 1, dtype=bool)
    new_text[words.text_bounds] = True
    edge = np.flatnonzero(inside & (~padded[:-2] | new_text[:-1]))
    finish = np.flatnonzero(inside & (~padded[2:] | new_text[1:])) + 1
    owner = np.searchsorted(words.text_bounds, edge, "right") - 1
    shift = words.text_bounds[owner]
    span = pa.StructArray.from_arrays([pa.array(edge - shift, pa.int64()), pa.array(finish - shift, pa.int64())], names=["start", "stop"])
    spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)), pa.int32()), span)
    base_failed = (n_words < MIN_WORDS) | (100 * repeat_words > 30 * n_words)
    chars = per_text(points, words.text_bounds)
    too_long = (longest >= LONG_REPEAT) & (100 * longest > MAX_LONGEST * n_words)
    kept = ~base_failed & (100 * covered_chars <= MAX_COVERED * chars) & ~too_long
    columns = {"n_words": n_words, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": lines, "n_repeat_words": repeat_words,
               "longest_repeat": longest, "covered_chars": covered_chars}
    out = {k: pa.array(v, pa.int64()) for k, v in columns.items()}
    return out | {"spans": spans, "base_failed": pa.array(base_failed), "kept": pa.array(kept)}


def repetition_rules(docs: DataFrame, text: str = "text", keep: list[str] | None = None, only_kept: bool = False, out: str | None = "rules") -> DataFrame:
    """The columns ``keep`` (default: all) of ``docs`` and one struct column ``out`` (see RULES; none if it is None).

    * ``n_repeat_words`` counts words inside substrings of at least 8 words that occur again in the same
      text; ``spans`` are their unions (word numbers), ``longest_repeat`` is the longest of them.
    * ``base_failed``: fewer than 20 words, or over 30 % of the words inside repeats.
    * ``kept``: not that, at most 30 % of the characters inside repeats, and no repeat of 24 words or more
      that is over 15 % of the text. ``only_kept`` leaves out all other rows.

    A null or empty text has no words: all counts are 0 and it fails. Ties and repeated rows are judged
    row by row; an empty table gives an empty table. A column named ``out`` in ``docs`` is replaced.
    Memory: one Arrow batch, and the suffix ranks of 1 MB of text or of one longer text.
    """
    keep = [c for c in (keep or docs.columns) if c != out]
    read, fields = carried(docs, keep, F.col(f"`{text}`"))
    made = [T.StructField(out, T.StructType.fromDDL(RULES))] if out else []
    schema = T.StructType([*fields, *made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, len(keep), SLICE_BYTES):
                rules = judge(part.column(len(keep)))
                struct = [pa.StructArray.from_arrays(list(rules.values()), names=list(rules))] if out else []
                judged = pa.RecordBatch.from_arrays([*part.columns[:-1], *struct], names=schema.names)
                yield judged.filter(rules["kept"]) if only_kept else judged

    return read.mapInArrow(tidy(run), schema)
