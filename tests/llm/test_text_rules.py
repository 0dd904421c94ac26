"""Extraction, repetition rules and the classifier against brute force and on odd input."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest

from gridloom.llm import html_extract, quality_cnn, repetition
from gridloom.llm.text import Words, texts_of

ODD = [None, "", " \n\t", "one", "a b c", " x", "the " * 3000, "Ä\nß  é", "a b\n" * 40, "x" * 20000]


def brute_repeats(text, least=8):
    words = (text or "").encode().split()
    n, inside, longest = len(words), set(), 0
    for i in range(n):
        for j in range(n):
            size = 0
            while i != j and i + size < n and j + size < n and words[i + size] == words[j + size]:
                size += 1
            if size >= least:
                longest = max(longest, size)
                inside.update(range(i, i + size))
    return len(inside), longest


def random_texts(n=60):
    draw = random.Random(3)
    out = [None, "", "a", "the " * 50, "a b " * 30]
    for _ in range(n):
        letters = "abcdefghijklmnopqrstuvwxyzäöü"[: draw.choice([1, 2, 3, 29])]
        text = draw.choice([" ", "\n", "  \t"]).join(draw.choice(letters) for _ in range(draw.randint(0, 70)))
        out.append(text + " x " + text if draw.random() < 0.5 else text)
    return out


def test_repeats_equal_brute_force():
    texts = random_texts()
    rules = repetition.judge(pa.array(texts))
    for i, text in enumerate(texts):
        assert (rules["n_repeat_words"][i].as_py(), rules["longest_repeat"][i].as_py()) == brute_repeats(text)
        assert sum(s["stop"] - s["start"] for s in rules["spans"][i].as_py()) == rules["n_repeat_words"][i].as_py()


def test_words_and_characters():
    words = Words(texts_of(pa.array(ODD)))
    assert words.counts().tolist() == [len((t or "").encode().split()) for t in ODD]
    rules = repetition.judge(pa.array(ODD))
    assert rules["word_chars"].to_pylist() == [sum(len(w.decode()) for w in (t or "").encode().split()) for t in ODD]


def test_rules_on_odd_rows(spark):
    rows = [(i, t, None, "x") for i, t in enumerate(ODD)] + [(None, "a b c", 1, None), (0, None, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rules int, _print string")
    out = repetition.repetition_rules(docs)
    assert out.columns == ["doc_id", "text", "_print", "rules"] and out.count() == len(rows)
    assert not out.filter("rules.n_words < 20 AND rules.kept").count()
    assert repetition.repetition_rules(docs.limit(0)).count() == 0


def test_long_repeat_fails_and_clean_text_stays():
    draw = random.Random(1)
    clean = [f"w{draw.randint(0, 10**9)}" for _ in range(150)]
    rules = repetition.judge(pa.array([" ".join(clean), " ".join(clean + clean[:30]), " ".join(clean + clean[:9])]))
    assert rules["kept"].to_pylist() == [True, False, True]


PAGES = [
    ("<article><h1>T</h1><p>One &amp; two.<p>Three<br>four</article><footer>no</footer>", "T\nOne & two.\nThree four"),
    ("<div class='header'><a>Home</a></div><div id=menu><a>a</a><a>b</a></div><div class=post>Hello <b>wor</b>ld<p>A rather long line of text here.<p>Short.</div>"
     "<div class=comments><p>A reader's long comment that goes on and on.</div><div><a>x</a><a>y</a></div>", "Hello world\nA rather long line of text here.\nShort."),
    ("<main><p>Text<aside>side</aside><form>name <input></form><script>var a='<p>no</p>'</script><style>p{}</style><p>more</main>", "Text\nmore"),
    ("<article class='post has-sidebar'><p>kept</article><article class='comment'><p>gone</article>", "kept"),
    ("<article><!-- gone --><p>a  b\n\tc<li>d</article><div class=cookie-notice>We use cookies</div>", "a b c\nd"),
    (None, ""), ("", ""), ("<nav>x</nav>", ""), ("plain words", "plain words"), ("<article><p>unclosed <b>bold", "unclosed bold"),
    ("<article><p>a &am b &#65; &nope; &lt;p&gt;</article>", "a &am b A &nope; <p>"),
]


def said(draw, n):
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 8))) for _ in range(n))


def pages_without_article(seed):
    """Pages without an article or main element, most without any telling name: (html, text). Ratios have to decide."""
    draw = random.Random(seed)
    title, one, two, three, short, note = said(draw, 6), said(draw, 60), said(draw, 45), said(draw, 80), said(draw, 4), said(draw, 9)
    menu = "".join(f"<li><a href=/{i}>{said(draw, 1)}</a></li>" for i in range(6))
    links = "".join(f"<a href=/{i}>{said(draw, 2)}</a> | " for i in range(8))
    story = f"<h1>{title}</h1><p>{one}</p><p>{short}</p><p>{two}</p>"
    text = "\n".join([title, one, short, two])
    return [
        (f"<div><ul>{menu}</ul></div><div>{story}</div>", text),
        (f"<div>{links}</div><div>{story}</div><div>{links}</div>", text),
        (f"<table><tr><td><ul>{menu}</ul></td><td>{story}</td></tr></table>", text),
        (f"<div><div><ul>{menu}</ul></div><div><h1>{title}</h1></div><div><p>{one}</p></div><div><p>{two}</p></div></div>", "\n".join([title, one, two])),
        (f"<body class='page comments-open'><div class='page no-sidebar'>{story}</div></body>", text),
        (f"<div>{story}</div><div><span>{said(draw, 1)}</span><span>{said(draw, 1)}</span><i>{said(draw, 1)}</i><b>{said(draw, 1)}</b><a href=/>{said(draw, 2)}</a></div>", text),
        (f"<ul>{menu}</ul><section>{story}</section><section>{links}</section>", text),
        (f"<form action=/><div>{story}</div><input type=hidden><select><option>{note}</select></form>", text),
        (f"<div class=content>{story}<div class=ad>{note}</div><p>{three}</p></div>", text + "\n" + three),
        (f"<div class=cookie-notice>{note}</div><div>{story}</div><div class=newsletter>{note}</div>", text),
        (f"<div>{story}</div><div id=comments><p>{note}</p><p>{note} {short}</p></div>", text),
        (f"<header><h2>{short}</h2></header><div>{story}</div><footer>{note}</footer>", text),
        (f"<nav>{menu}</nav><aside>{two}</aside><div>{story}</div><script>x</script>", text),
        (f"<div><p>{one}<p>{two}<p>{three}</div><div class=share>{links}</div>", "\n".join([one, two, three])),
        (f"<p>{one}</p><p>{short}</p><p>{two}</p>", "\n".join([one, short, two])),
    ]


@pytest.mark.parametrize("html,text", pages_without_article(1) + pages_without_article(2))
def test_main_text_by_ratios(html, text):
    assert html_extract.main_text(html) == text


NAMED = [
    ('<div class="page no-sidebar"><p>long text</p></div>', "long text"), ('<div class="site no-sidebar"><article><p>a long text of it</article></div>', "a long text of it"),
    ('<main><div class="legal-news"><p>long text', "long text"), ("<div><h1>Title</h1></div><div><p>long text that goes on and on</div>", "Title\nlong text that goes on and on"),
    ("<div>short</div><div>long text that goes on and on</div><div>short</div>", "short\nlong text that goes on and on\nshort"),
    ("<article><p>the story itself</article><div id=comments><article><p>a long comment of a reader that is longer than the story</article></div>", "the story itself"),
]


@pytest.mark.parametrize("html,text", NAMED)
def test_names_do_not_delete_the_text(html, text):
    assert html_extract.main_text(html) == text


def test_time_follows_the_length_of_the_page():
    deep = ["<div>" * n + "<p>x<p>y" for n in (20_000, 80_000)] + ["<div><p>" * 20_000 + "<li>a</span></b>" * 20_000, "<ul><li>" * 20_000]
    start = time.process_time()
    for html in deep:
        html_extract.main_text(html)
    assert time.process_time() - start < 10


@pytest.mark.parametrize("html,text", PAGES)
def test_main_text(html, text):
    assert html_extract.main_text(html) == text


def test_extraction_columns(spark):
    pages = spark.createDataFrame([(i, None, h, 5, "old", i) for i, (h, _) in enumerate(PAGES)], "page_id long, url string, html string, n_chars int, text string, _html long")
    got = html_extract.extract(pages).orderBy("page_id").collect()
    assert [(r["text"], r["n_chars"]) for r in got] == [(t, len(t)) for _, t in PAGES]
    assert html_extract.extract(pages.limit(0)).columns == ["page_id", "url", "_html", "text", "n_chars"]


def test_smoothing_and_threshold():
    values = [1.0, 1.0, 40.0, 50.0, 45.0, 2.0]
    assert html_extract.threshold(values) == pytest.approx((sum([1, 1, 2]) / 3 + 45) / 2)
    assert html_extract.smoothed([3.0] * 5) == pytest.approx([3.0] * 5)


def test_gradients_are_slopes():
    network = quality_cnn.Network()
    texts, labels = [b"some words here " * 20, b"### $$$ %%% " * 30, b"", b"x"], np.array([1, 0, 1, 0], np.float32)
    found = network.gradients(quality_cnn.joined(texts), labels)

    def loss():
        p = network.forward(quality_cnn.joined(texts))["chance"].astype(float)
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    for parameter, gradient in zip(network.parameters(), found, strict=True):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        old, step = parameter[at].copy(), 1e-3
        parameter[at] = old + step
        high = loss()
        parameter[at] = old - step
        low = loss()
        parameter[at] = old
        assert gradient[at] == pytest.approx((high - low) / (2 * step), rel=0.1, abs=2e-3)


def test_score_sees_every_byte_and_not_its_neighbours():
    network = quality_cnn.Network()
    texts = [b"", b"a", b"abc " * 200, b"z" * 1000]
    together = network.forward(quality_cnn.joined(texts))["chance"]
    alone = [network.forward(quality_cnn.joined([t]))["chance"][0] for t in texts]
    assert together == pytest.approx(alone, rel=1e-5)
    last = network.forward(quality_cnn.joined([b"abc " * 200 + b"#"]))["chance"][0]
    assert last != pytest.approx(alone[2], rel=1e-7)


def test_held_out_accuracy(spark, sf_dir):
    from gridloom.llm import queries

    got = queries.QUERIES["op4_quality_classifier"](spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    rows = got.filter("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.9
    high, low = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert np.mean([a > b for a in high for b in low]) > 0.95


def test_classifier_on_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(ODD)] + [(None, None, None)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(0, 1), (4, 0), (4, 1), (None, 1), (6, None)], "doc_id long, quality int")
    from pyspark.sql import functions as F

    network = quality_cnn.fit(docs, labels, F.lit(True))
    assert all(0 <= r["score"] <= 1 for r in quality_cnn.score(docs, network).collect())
    assert quality_cnn.score(docs.limit(0), quality_cnn.fit(docs.limit(0), labels.limit(0), F.lit(True))).count() == 0


def test_ratios_decide_on_pages_with_an_article_too():
    long = [f"<p>{'A long line of the story that goes on and on. ' * 6}{k}</p>" for k in range(6)]
    story = "\n".join(x[3:-4] for x in long)
    card = "<article class='quote'><p>A short quote.</p></article><div class='story'>" + "".join(long) + "</div>"
    assert story in html_extract.main_text(card)
    second = "<article>" + "".join(long) + "</article><article><h2>Next</h2><p>Short.</p><p>More here.</p><p>Read on.</p><p>Also.</p></article>"
    assert html_extract.main_text(second) == story


def test_scores_do_not_depend_on_pieces_or_neighbours():
    """Long texts go through the filters in pieces; a plain loop over windows and chunks gives the same."""
    draw = np.random.default_rng(4)
    texts = [bytes(draw.integers(0, 256, n, dtype=np.uint8)) for n in (0, 1, 4, 127, 128, 129, 1000, 3000)]
    network = quality_cnn.Network(3)

    def plain(text):
        data = np.frombuffer(text + bytes(quality_cnn.WIDTH), np.uint8)
        size, block = max(1, len(text)), quality_cnn.BLOCK
        out = [sum(network.filters[k][data[i + k]] for k in range(quality_cnn.WIDTH)) for i in range(size)]
        tops = [np.max(out[i : i + block], axis=0) for i in range(0, size, block)]
        chunks = [np.maximum(a, b) + network.bias for a, b in zip(tops, [*tops[1:], tops[-1]])]
        hidden = np.array([np.maximum(np.maximum(c, 0) @ network.w1 + network.b1, 0) for c in chunks])
        return 1 / (1 + np.exp(-(np.concatenate([hidden.mean(axis=0), hidden.max(axis=0)]) @ network.w2 + network.b2[0])))

    want = [plain(t) for t in texts]
    before = quality_cnn.PIECE
    for piece in (1, 200, 96 << 10):
        quality_cnn.PIECE = piece
        got = network.forward(quality_cnn.joined(texts))["chance"]
        assert np.allclose(got, want, atol=1e-5)
    quality_cnn.PIECE = before


def test_columns_with_names_of_helpers(spark):
    docs = spark.createDataFrame([(1, "some words here", 5, "x", 2.0)], "doc_id long, text string, _scored int, _judged string, score double")
    out = quality_cnn.score(docs, quality_cnn.Network(1))
    assert out.columns == ["doc_id", "text", "_scored", "_judged", "score"] and out.first()["_scored"] == 5
    judged = repetition.repetition_rules(docs, out=None)
    assert judged.columns == docs.columns and judged.first()["_judged"] == "x"
