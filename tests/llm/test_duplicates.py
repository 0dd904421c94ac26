"""Near duplicates, repeats, contamination and components against brute force, hot groups and odd rows."""

import random

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from gridloom.llm import decontaminate, ngram_join, paragraph_dedup, simhash
from gridloom.llm.components import components

DRAW = random.Random(9)
VOCABULARY = ["".join(DRAW.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(DRAW.randint(2, 9))) for _ in range(3000)]


def prose(draw, n):
    return [draw.choice(VOCABULARY) for _ in range(n)]


def shingles(text, size=5):
    words = (text or "").lower().encode().split()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} if words else set()


def roots(n, links):
    up = list(range(n))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


@pytest.mark.parametrize("links", [[], [(5, 3), (3, 5), (4, 4), (None, 2)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 300)], None])
def test_components(spark, links):
    if links is None:
        draw = random.Random(2)
        links = [(draw.randint(0, 400), draw.randint(0, 400)) for _ in range(250)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "x long, y long")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    want = roots(401, real)
    assert got == {n: want[n] for link in real for n in link}


def test_masks_cover():
    for radius in (1, 2, 3):
        masks = simhash.covering_masks(radius, 16)
        draw = random.Random(radius)
        for _ in range(500):
            flips = sum(1 << b for b in draw.sample(range(16), radius))
            assert any(not m & flips for m in masks)


def brute_print(text, size=3):
    words = (text or "").encode()
    words = bytes(b + 32 if 65 <= b <= 90 else b for b in words).split()
    parts = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] if len(words) >= size else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_components_of_documents(spark):
    draw = random.Random(4)
    texts = [None, "", " \n", "One", "one two", "ONE  two", "Ä b c"]
    for _ in range(40):
        base = prose(draw, draw.randint(3, 400))
        texts += [" ".join(base), " ".join(base).upper(), " ".join([*base[:-1], "changed"])]
    rows = [(i * 7 % 1000, t, 0) for i, t in enumerate(texts)] + [(None, texts[3], 1), (0, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    got = simhash.near_duplicates(docs).collect()
    prints = [brute_print(t) for _, t, _ in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    root = roots(len(rows), links)
    least = {}
    for i, (key, _, _) in enumerate(rows):
        if key is not None:
            least[root[i]] = min(key, least.get(root[i], key))
    want = sorted((-1 if k is None else k, prints[i], least[root[i]]) for i, (k, _, _) in enumerate(rows))
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["_print"] % (1 << 64), r["component_id"]) for r in got) == want
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_links_at_every_distance(spark):
    draw = random.Random(8)
    base = [draw.getrandbits(64) for _ in range(60)]
    prints = list(dict.fromkeys(base + [b ^ sum(1 << x for x in draw.sample(range(64), k)) for b in base for k in (1, 2, 3)]))
    frame = spark.createDataFrame([(simhash.signed(p),) for p in prints], "_print long")
    found = [(r["a"], r["b"]) for r in simhash.close_links(frame).collect()]
    assert all((a % (1 << 64) ^ b % (1 << 64)).bit_count() <= 2 for a, b in found)
    at = {simhash.signed(p): i for i, p in enumerate(prints)}
    want = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2]
    assert roots(len(prints), [(at[a], at[b]) for a, b in found]) == roots(len(prints), want)


def corpus():
    """Clean texts, copies, near copies (similarity 0.8 to 1), and rows with nulls."""
    draw = random.Random(6)
    rows, group = [], []
    for i in range(40):
        words = prose(draw, draw.randint(60, 500))
        rows.append(words)
        group.append(i)
    for i in range(12):
        for _ in range(draw.choice([1, 2, 20])):
            words = list(rows[i])
            for at in draw.sample(range(len(words)), draw.randint(0, max(1, len(words) // 60))):
                words[at] = draw.choice(VOCABULARY)
            rows.append(words)
            group.append(i)
    return [(k, " ".join(w), "en", "s", 1) for k, w in enumerate(rows)]


def brute_join(rows):
    """(key, n_shingles, component_id) of every row."""
    sets = [shingles(r[1]) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    root = roots(len(rows), links)
    low = {}
    for i, r in enumerate(rows):
        low[root[i]] = min((k for k in (low.get(root[i]), r[0]) if k is not None), default=None)
    return sorted((-1 if r[0] is None else r[0], len(sets[i]), -1 if low[root[i]] is None else low[root[i]]) for i, r in enumerate(rows))


def joined(docs):
    return sorted(tuple(-1 if v is None else v for v in r) for r in ngram_join.similar(docs).collect())


ODD = [(None, None, None, None, None), (900, "", "", "", 0), (904, " \n\t", "", "", 0), (901, "tiny", None, None, None), (902, "Tiny", None, None, None), (None, "tiny", "a", "b", 1)]


def test_join_against_brute_force(spark, monkeypatch):
    rows = corpus() + ODD + [(3, "another text under a key that is there already", "", "", 0), (903, "one two three four", "", "", 1), (905, "one two three four five", "", "", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string, prefix string, n int")
    got = ngram_join.similar(docs)
    assert got.columns == ["_key", "n_shingles", "component_id"]
    assert joined(docs) == brute_join(rows)
    assert sum(k != c for k, _, c in joined(docs)) > 30
    monkeypatch.setattr(ngram_join, "SENT_ROWS", 0)
    assert joined(docs) == brute_join(rows)
    assert ngram_join.similar(docs.limit(0)).count() == 0


def test_join_filters_lose_no_pair():
    """Prefix, length, positional and suffix filters hold for every pair at the threshold, for any common order."""
    draw = random.Random(3)
    for _ in range(2000):
        whole = draw.sample(range(10000), draw.randint(1, 60))
        x, y = set(whole), set(whole)
        while True:
            (x if draw.random() < 0.5 else y).symmetric_difference_update({draw.randint(0, 10000)})
            if not x or not y or 100 * len(x & y) < 80 * len(x | y):
                break
            first = min(x & y)
            i, j = sorted(x).index(first), sorted(y).index(first)
            assert i < ngram_join.prefix_length(len(x), 80) and j < ngram_join.prefix_length(len(y), 80)
            both = len(x) + len(y)
            assert 180 * min(len(x) - i, len(y) - j) >= 80 * both
            apart = sum(abs(sum(e % 16 == k for e in x) - sum(e % 16 == k for e in y)) for k in range(16))
            assert 180 * (both - apart) >= 160 * both


def test_sketches_lose_no_pair(spark):
    """Two sets at the threshold pass the parity filter whatever their sizes, and unlike ones mostly do not."""
    draw = np.random.default_rng(4)
    rows = []
    for n in (1, 3, 60, 64, 65, 70, 128, 500, 1030, 5000):
        for _ in range(40):
            own = draw.integers(0, 1 << 63, n).astype(np.uint64)
            other = np.union1d(own[int(n * draw.uniform(0, 0.25)) :], draw.integers(0, 1 << 63, int(n * draw.uniform(0, 0.25))).astype(np.uint64))
            both = len(np.intersect1d(own, other))
            true = 100 * both >= 80 * (len(own) + len(other) - both)
            rows.append(("true" if true else "close", len(own), ngram_join.parities(own).tolist(), len(other), ngram_join.parities(other).tolist()))
            far = draw.integers(0, 1 << 63, n).astype(np.uint64)
            rows.append(("far", len(own), ngram_join.parities(own).tolist(), len(far), ngram_join.parities(far).tolist()))
    pairs = spark.createDataFrame(rows, "kind string, n long, bits array<bigint>, m long, other array<bigint>")
    sides = pairs.selectExpr("kind", "struct(n, bits) AS a", "struct(m AS n, other AS bits) AS b").filter("100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)")
    passed = sides.filter(ngram_join.parity_filter(80))
    assert passed.filter("kind = 'true'").count() == sum(r[0] == "true" for r in rows) > 50
    assert passed.filter("kind = 'far' AND a.n > 100").count() == 0


def test_one_of_each_group_of_near_duplicates_stays(spark):
    rows = corpus() + ODD
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row string, source string, n_chars int")
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    component = {}
    prints = [brute_print(r[1]) for r in rows]
    root = roots(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 2])
    for i, r in enumerate(rows):
        component.setdefault(root[i], []).append((r[0] is None, r[0]))
    want = sorted(min(c)[1] if not min(c)[0] else -1 for c in component.values())
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in kept.collect()) == want
    assert simhash.without_near_duplicates(docs.limit(0)).count() == 0


def windows(text, n):
    words = (text or "").lower().encode().split()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def test_repeated_passages_go_but_for_one(spark):
    draw = random.Random(12)
    passages = [" ".join(prose(draw, n)) for n in (55, 60, 75, 90, 140)]
    rows = []
    for i in range(60):
        parts = [" ".join(prose(draw, draw.randint(5, 80))) for _ in range(4)]
        if i % 2:
            parts.insert(2, passages[i % len(passages)])
        rows.append((i, draw.choice([" ", "\n"]).join(parts)))
    rows += [(100, None), (101, ""), (102, passages[0]), (None, "a b"), (103, passages[2].upper())]
    docs = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, start string")
    out = {r["doc_id"]: r["text"] for r in paragraph_dedup.remove_repeats(docs).collect()}
    for i in range(0, 60, 2):
        assert out[i] == rows[i][1]
    for p in passages:
        whole = windows(p, 50)
        assert sum(bool(whole & windows(t, 50)) for t in out.values()) == 1
    assert out[100] is None and out[101] == "" and 102 not in out
    found = paragraph_dedup.stretches(paragraph_dedup.repeats(docs)).collect()
    assert {r["_key"] for r in found} <= {i for i in range(60) if i % 2} | {102, 103}
    assert paragraph_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_near_equal_paragraphs_are_one_class(spark):
    draw = random.Random(13)
    line = prose(draw, 120)
    changed = [[*line[:k], "other", *line[k + 1 :]] for k in (20, 60, 90)]
    rows = [(i, " ".join(prose(draw, 30)) + "\n" + " ".join(x)) for i, x in enumerate([line, *changed])] + [(9, " ".join(prose(draw, 120)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in paragraph_dedup.remove_repeats(docs).collect()}
    assert out[0] == rows[0][1] and out[9] == rows[4][1]
    assert all(out[i].strip() == rows[i][1].split("\n")[0] for i in (1, 2, 3))


def test_cut_keeps_all_other_words():
    text = "  a b\n c  d\te f "
    assert paragraph_dedup.without_words(text, [{"start": 1, "stop": 3}]) == "  a d\te f "
    assert paragraph_dedup.without_words(text, [{"start": 0, "stop": 1}, {"start": 4, "stop": 6}]) == "  b\n c  d\t"
    assert paragraph_dedup.without_words("Ä ö ü", [{"start": 0, "stop": 3}]) == ""


def test_contained_items(spark):
    draw = random.Random(14)
    items = [(i, " ".join(prose(draw, draw.choice([2, 5, 9, 20, 60, 200])))) for i in range(40)] + [(None, "null item here with words"), (50, None), (51, ""), (52, items_text := "x y z q r s t")]
    rows = []
    for i in range(150):
        words = prose(draw, draw.randint(0, 600))
        if i % 3 == 0:
            item = items[i % 40][1].split()
            for at in draw.sample(range(len(item)), min(len(item), draw.choice([0, 0, 1, 3]))):
                item[at] = "changed"
            words = [*words[:50], *item, *words[50:]]
        rows.append((i, " ".join(words).title() if i % 5 else " ".join(words)))
    rows += [(None, "null item here with words"), (200, None), (201, ""), (202, items_text), (202, items_text), (203, items[0][1])]
    docs = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, item_id int")
    tests = spark.createDataFrame([(k, t, "h") for k, t in items], "item_id long, text string, h string")
    sets, item_sets = {}, {}
    for k, t in rows:
        sets.setdefault(k, set()).update(shingles(t))
    for k, t in items:
        item_sets.setdefault(k, set()).update(shingles(t))
    want = {(k, i, len(x & y), len(y)) for k, x in sets.items() for i, y in item_sets.items() if y and len(x & y) >= 0.8 * len(y)}
    got = decontaminate.contained(docs, tests)
    assert {(r["doc_id"], r["item_id"], r["n_found"], r["n_shingles"]) for r in got.collect()} == want and len(want) > 20
    left = decontaminate.without(docs, got)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == set(sets) - {w[0] for w in want}
    assert decontaminate.contained(docs.limit(0), tests).count() == decontaminate.contained(docs, tests.limit(0)).count() == 0


def test_large_items_are_not_missed_by_the_sketch(spark):
    """Without a broadcast the plan joins by shuffle and gives the same pairs."""
    docs, tests = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    small = {tuple(r) for r in decontaminate.contained(docs, tests).collect()}
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, -1)
        assert {tuple(r) for r in decontaminate.contained(docs, tests).collect()} == small
    finally:
        spark.conf.set(name, before)


def test_pipeline_keeps_clean_documents(spark, tmp_path):
    draw = random.Random(21)
    clean = [(i, "\n".join(" ".join(prose(draw, 40)) for _ in range(5))) for i in range(30)]
    bench = [(i, " ".join(prose(draw, 40))) for i in range(5)]
    passage = " ".join(prose(draw, 70))
    more = [(100, clean[3][1]), (101, clean[4][1].replace("\n", "\nnew ", 1)), (102, "the " * 200), (103, "few words"), (104, " ".join(prose(draw, 80)) + " " + bench[2][1] + " " + " ".join(prose(draw, 80)))]
    more += [(k, " ".join(prose(draw, 60)) + " " + passage + " " + " ".join(prose(draw, 60))) for k in (105, 106)] + [(None, None), (107, "")]
    rows = [(k, t, "en", "s", len(t or ""), 1, "a", 2.0, [3]) for k, t in clean + more]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, rules int, _judged string, _spans double, _text array<int>").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.dtypes == docs.dtypes
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    left = {r["doc_id"]: r for r in docs.collect()}
    assert set(left) == set(range(30)) | {105, 106}
    assert all(left[k]["text"] == t and left[k]["n_chars"] == len(t) for k, t in clean)
    assert passage in left[105]["text"] and passage not in left[106]["text"] and left[106]["n_chars"] == len(left[106]["text"])
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in packed.collect()} == set(left)
    assert len(corpus_pipeline.STAGES) == 5


def variants(draw, words, n, changed):
    """A text and ``n`` copies with ``changed`` words replaced, which are less like each other than like the text."""
    out = [words]
    for _ in range(n):
        copy = list(words)
        for at in draw.sample(range(len(words)), changed):
            copy[at] = draw.choice(VOCABULARY)
        out.append(copy)
    return out


def test_all_variants_of_one_text_are_linked(spark):
    draw = random.Random(31)
    rows = [(i, " ".join(w)) for i, w in enumerate(variants(draw, prose(draw, 450), 2000, 7))]
    sets = [shingles(t) for _, t in rows]
    assert all(len(sets[0] & x) >= 0.8 * len(sets[0] | x) for x in sets)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["component_id"] for r in ngram_join.similar(docs).collect()} == {0}


def test_all_variants_of_one_paragraph_are_linked(spark):
    draw = random.Random(33)
    lines = [" ".join(w) for w in variants(draw, prose(draw, 100), 300, 2)]
    sets = [shingles(x) for x in lines]
    links = [(i, j) for i in range(len(lines)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    root = roots(len(lines), links)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    found = {r["_key"] for r in paragraph_dedup.repeats(docs).filter("stop - start = 100 AND kept_in = 0").collect()}
    missed = {i for i in range(1, len(lines)) if root[i] == 0} - found
    assert len(missed) <= 0.03 * len(lines)


def test_blocks_added_and_long_texts_of_few_words_are_found(spark):
    draw = random.Random(32)
    rows = []
    for n in (40, 100, 400, 1500):
        for _ in range(10):
            base = prose(draw, n)
            rows += [base, [*base, *prose(draw, int(n * 0.23))], base[: int(n * 0.83)]]
    few = [VOCABULARY[draw.randint(0, 999)] for _ in range(9000)]
    new = list(few)
    for at in draw.sample(range(9000), 200):
        new[at] = f"new{at}"
    rows = [(i, " ".join(w)) for i, w in enumerate([*rows, few, new])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_join(rows)
    assert sum(k != c for k, _, c in want) > 60
    assert joined(docs) == want
