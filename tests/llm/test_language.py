"""Context-tree scores against one tree in one process; quotation links against SQL and by hand."""

import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from gridloom.llm import ctw, queries, quotes
from gridloom.llm.text import texts_of
from workloads.compare import compare


def rows_of_texts():
    draw = random.Random(5)
    texts = [None, "", "a", "A", "Ä ö\n", "the end " * 400]
    texts += [" ".join(draw.choice(["the", "cat", "Sat", "on", "mat", "würde", "x1"]) for _ in range(draw.randint(0, 60))) for _ in range(150)]
    return [(i, t, "x") for i, t in enumerate(texts)] + [(None, "no key", None), (3, "A", "x")]


def held(key):
    return key is not None and zlib.crc32(str(key).encode()) % 5 == 1


@pytest.mark.parametrize("depth", [2, 5])
def test_scores_equal_one_tree(spark, monkeypatch, depth):
    monkeypatch.setattr(ctw, "GROUP_BYTES", 700)
    monkeypatch.setattr(ctw, "CHUNK_KEYS", 50)
    rows = rows_of_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string, held_out string")
    got = ctw.context_tree_scores(docs, ctw.told_apart("doc_id", 5, 1), depth=depth).collect()
    assert len(got) == len(rows)
    texts = [(t or "") for _, t, _ in rows]
    keys, bounds = ctw.grams(texts_of(pa.array(texts)).lowered(), depth)
    trains = np.repeat([not held(k) for k, _, _ in rows], np.diff(bounds))
    known, inverse = np.unique(keys, return_inverse=True)
    tree = ctw.Tree(known, np.bincount(inverse, weights=trains), depth, 0)
    value = np.zeros(len(known))
    for j in range(8):
        chance, seen = tree.chances(j)
        chance = np.where(seen, chance, 0.5)
        value += np.log10(np.where(known >> (7 - j) & 1, chance, 1 - chance))
    want = np.add.reduceat(value[inverse], bounds[:-1])
    lower = [t.encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))).split() for t in texts]
    counts = Counter(w for (k, _, _), ws in zip(rows, lower, strict=True) if not held(k) for w in ws)
    ends = sum(not held(k) for k, _, _ in rows)
    total, below = sum(counts.values()) + ends, sum(counts.values()) + ends + 0.5 * (len(counts) + 2)
    expected = []
    for (k, _, _), ws, score in zip(rows, lower, want, strict=True):
        base = sum(math.log10((counts[w] + 0.5) / below) for w in ws) + math.log10((ends + 0.5) / below)
        expected.append((-1 if k is None else k, held(k), len(ws) + 1, sum(counts[w] > 0 for w in ws) + 1, total, base, float(score)))
    found = [(-1 if r["doc_id"] is None else r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got]
    for a, b in zip(sorted(found), sorted(expected), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], abs=1e-6)
    assert ctw.context_tree_scores(docs.limit(0), ctw.told_apart("doc_id", 5, 1)).count() == 0


def test_chances_of_all_bytes_add_up_to_one():
    """The model is a distribution: the chances of all 256 bytes in a context sum to one."""
    keys, _ = ctw.grams(texts_of(pa.array(["abracadabra " * 3, "banana"])), 3)
    known, counts = np.unique(keys, return_counts=True)
    for context in np.unique(known >> 8):
        every = (context << 8) + np.arange(256)
        both = np.union1d(known, every)
        n = np.zeros(len(both))
        n[np.searchsorted(both, known)] = counts
        tree, value = ctw.Tree(both, n, 3, 0), np.zeros(len(both))
        for j in range(8):
            chance, seen = tree.chances(j)
            value += np.log(np.where(both >> (7 - j) & 1, chance, 1 - chance))
        assert np.exp(value[np.searchsorted(both, every)]).sum() == pytest.approx(1)


def test_krichevsky_trofimov():
    for zeros, ones in [(0, 0), (1, 0), (3, 2), (40, 0), (1000, 7)]:
        want = sum(math.log((i + 0.5) / (i + 1)) for i in range(zeros)) + sum(math.log((i + 0.5) / (zeros + i + 1)) for i in range(ones))
        assert ctw.log_kt(np.array([float(zeros)]), np.array([float(ones)]))[0] == pytest.approx(want, abs=1e-9)


def test_scores_beat_word_counts_on_held_out_texts(spark):
    got = queries.QUERIES["op5_context_tree_scores"](spark, "/root/testdata/sf0.1").filter("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert got["s"] > got["b"]


def quoting_rows():
    draw = random.Random(5)
    lines = ["Hello there", "ok", "Yes  I do", "What about\tthat", "no", "thanks a lot", ""]
    rows = []
    for conv in range(12):
        earlier = []
        for turn in range(draw.choice([1, 4, 30])):
            body = [draw.choice(lines) + (str(draw.randint(0, 3)) if draw.random() < 0.7 else "") for _ in range(draw.randint(0, 4))]
            if earlier and draw.random() < 0.7:
                body = [draw.choice(["> ", ">", ">\t"]) + (x.upper() if draw.random() < 0.3 else x) for x in draw.choice(earlier).split("\n")] + body
            earlier.append("\n".join(body))
            rows.append((conv, turn * draw.choice([1, 1, 300]), draw.choice(["user", "assistant"]), earlier[-1], 5))
    return rows + rows[:5] + [(None, 3, "user", "> ok", 1), (1, None, "user", "ok", 1), (2, 3, None, None, None), (2, 900, "user", "", 0)]


def test_links_equal_sql(spark, tmp_path):
    frame = spark.createDataFrame(quoting_rows(), "conv_id long, turn long, role string, text string, reply_to int")
    frame.select("conv_id", "turn", "role", "text").write.parquet(f"{tmp_path}/c")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/c/*.parquet'")
    ok, note = compare(quotes.link_quotes(frame), con, queries.QUOTES_SQL)
    assert ok, note
    assert quotes.link_quotes(frame.limit(0)).count() == 0


def test_nested_quotes(spark):
    rows = [(1, 0, "a", "First question\nsecond line"), (1, 1, "b", "> First question\nAn answer"), (1, 2, "c", "Aside"),
            (1, 3, "a", "> > first  QUESTION\n> An answer\nThanks"), (1, 4, "d", ">Thanks\n> Aside\n> second line\nall")]
    got = {r["turn"]: r for r in quotes.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert [got[t]["reply_to"] for t in range(5)] == [None, 0, None, 1, 3]
    assert [(got[t]["thread"], got[t]["depth"], got[t]["max_level"]) for t in range(5)] == [(0, 0, 0), (0, 1, 1), (2, 0, 0), (0, 2, 2), (0, 3, 1)]
    assert [got[t]["text"] for t in (1, 3, 4)] == ["An answer", "Thanks", "all"]
    order = quotes.in_reply_order(quotes.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()
    assert [r["turn"] for r in order] == [0, 1, 3, 4, 2] and [r["position"] for r in order] == [1, 2, 3, 4, 5]


def test_deeper_levels_and_other_line_breaks(spark):
    rows = [(1, 0, "a", "one two three\nfour five\n\nanother paragraph"), (1, 1, "b", "> one two\n> three four five\nan answer"),  # other line breaks
            (1, 2, "c", "> > one two\n> > three four five\n> an answer\nagreed"), (1, 3, "d", ">> one two\n>> three four five\n"),  # the parent's quote, one level deeper
            (1, 4, "e", ">>> another\n>>> paragraph\nlate"),  # nobody quoted it: the original
            (1, 5, "f", "> one two three\nfour five"), (1, 6, "g", "> never said")]
    got = {r["turn"]: r for r in quotes.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert [got[t]["reply_to"] for t in range(7)] == [None, 0, 1, 1, 0, 0, None]
    assert [got[t]["text"] for t in (1, 2, 3, 4)] == ["an answer", "agreed", "", "late"] and got[4]["max_level"] == 3
    assert [got[t]["position"] for t in range(7)] == [1, 2, 3, 4, 5, 6, 7]


def test_nested_and_wrapped_quotes_equal_sql(spark, tmp_path):
    draw = random.Random(15)
    words = ["alpha", "beta", "gamma", "delta"]
    rows = []
    for conv in range(15):
        earlier = []
        for turn in range(draw.choice([2, 6, 20])):
            body = [" ".join(draw.choice(words) for _ in range(draw.randint(0, 5))) for _ in range(draw.randint(1, 4))]
            if earlier and draw.random() < 0.8:
                quoted = draw.choice(earlier).split("\n")
                if draw.random() < 0.4:
                    quoted = [w for x in quoted for w in ([x[: len(x) // 2], x[len(x) // 2 :].strip()] if not x.startswith(">") else [x])]
                body = [draw.choice(["> ", ">", "> > "]) + x for x in quoted] + body
            earlier.append("\n".join(body))
            rows.append((conv, turn, draw.choice(["user", "assistant", None]), earlier[-1]))
    rows += [(3, None, "user", "> alpha"), (None, None, None, None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame.write.parquet(f"{tmp_path}/c")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/c/*.parquet'")
    ok, note = compare(quotes.link_quotes(frame), con, queries.QUOTES_SQL)
    assert ok, note


def test_no_python_in_native_plans(spark):
    for name in ("op7_quotation_linking", "op10_decontamination"):
        plan = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
