"""Tokenizing by words, packing and token files: exact against the tokenizer itself, and round trips."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from gridloom.llm import packing, pfor
from gridloom.llm.text import texts_of
from gridloom.llm.tokens import LETTERS, Encoder
from gridloom.session import fresh_path

BYTES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
SPACES = [" ", "  ", "\n", "\n\n", "\t", " \n ", " ", " ", "\x1c", "\x85", "　", "\r\n", "  ", "  ", "  "]
PARTS = ["the", "It's", "we'll", "Ñandú", "123", "!!", "á", "漢字", "😀", "<|endoftext|>", "don't", "Σ", "\x00", "“x”"]


def odd_texts(n=400):
    draw = random.Random(11)
    return [None, "", " ", "\n"] + ["".join(draw.choice(SPACES if draw.random() < 0.6 else PARTS) for _ in range(draw.randint(0, 25))) for _ in range(n)]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_ids_by_words_are_those_of_the_whole_text(path):
    texts = odd_texts()
    ids, bounds = Encoder(path).encode(texts_of(pa.array(texts)))
    plain = Tokenizer.from_file(path)
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == plain.encode(text or "", add_special_tokens=False).ids, text


@pytest.mark.parametrize("words,ids", [(3, 100), (20, 10_000), (20, 15)])
def test_words_are_forgotten_and_learnt_again(monkeypatch, words, ids):
    monkeypatch.setattr("gridloom.llm.tokens.MAX_WORDS", words)
    monkeypatch.setattr("gridloom.llm.tokens.MAX_IDS", ids)
    encoder, texts = Encoder(BYTES), odd_texts(30)
    once = Encoder(BYTES).encode(texts_of(pa.array(texts)))[0].tolist()
    pieces = [encoder.encode(texts_of(pa.array([t], pa.string())))[0].tolist() for t in texts]
    assert sum(pieces, []) == once


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 1000])
def test_blocks_round_trip(n):
    draw = np.random.default_rng(n)
    for high in (1, 50, 50_000, 2**32):
        ids = draw.integers(0, high, n, dtype=np.uint64).astype(np.uint32)
        ids[::50] = 2**32 - 1  # exceptions
        index, payload = pfor.encode_blocks(ids)
        assert pfor.decode_blocks(index, np.frombuffer(payload, np.uint8))[:n].tolist() == ids.tolist()


def test_reading_part_of_a_file():
    ids = np.arange(1000, dtype=np.uint32) * 7 % 501
    reader = pfor.Reader(pfor.to_bytes(ids, np.array([400, 600]), [5, None]))
    assert reader.ids(130, 700).tolist() == ids[130:700].tolist() and reader.keys.to_pylist() == [5, None]


def test_packing_of_narrow_ids_saves_space():
    ids = np.random.default_rng(0).integers(1000, 1256, 12_800).astype(np.uint32)
    assert len(pfor.to_bytes(ids, np.array([12_800]), [1])) < 12_800 * 1.3


def docs_with_odd_rows(spark):
    rows = [(i * 3 % 101, t, i, "x") for i, t in enumerate(odd_texts(80))] + [(None, "null key", 1, None), (7, "same", 1, None), (7, "same", 1, None), (500, "word and " * 3000, 0, "")]
    return spark.createDataFrame(rows, "doc_id long, text string, length long, _key string"), rows


def test_token_files(spark):
    docs, rows = docs_with_odd_rows(spark)
    uri = fresh_path(spark, "tokens")
    pfor.write_tokens(docs, uri, WORDS)
    got = sorted(pfor.read_tokens(spark, uri, with_ids=True).collect(), key=lambda r: r["start"])
    plain = Tokenizer.from_file(WORDS)
    assert [(-1 if r["doc_id"] is None else r["doc_id"]) for r in got] == sorted(-1 if r[0] is None else r[0] for r in rows)
    at = 0
    want = sorted((-1 if k is None else k, plain.encode(t or "", add_special_tokens=False).ids + [1]) for k, t, *_ in rows)
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["ids"]) for r in got) == want
    for r in got:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        at += r["n_tokens"]
    uri = fresh_path(spark, "tokens")
    pfor.write_tokens(docs.limit(0), uri, WORDS)
    assert pfor.read_tokens(spark, uri).count() == 0


def test_packing(spark):
    docs, rows = docs_with_odd_rows(spark)
    got = packing.pack(docs, BYTES, most=64, with_ids=True).collect()
    plain = Tokenizer.from_file(BYTES)
    want = sorted((-1 if k is None else k, plain.encode(t or "", add_special_tokens=False).ids + [2]) for k, t, *_ in rows)
    by_doc: dict = {}
    for r in sorted(got, key=lambda r: (r["piece"])):
        if r["doc_id"] not in (None, 7):
            assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and (r["piece"] == 0 or r["length"] == 64)
            assert r["start"] == len(by_doc.get(r["doc_id"], []))
            by_doc.setdefault(r["doc_id"], []).extend(r["ids"])
    single = {k: ids for k, ids in want if k not in (-1, 7) and sum(k == x for x, _ in want) == 1}
    assert {k: by_doc[k] for k in single} == single
    places: dict = {}
    for r in sorted(got, key=lambda r: r["offset"]):
        assert r["offset"] == places.get(r["sequence_id"], 0)
        places[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(places.values()) <= 64 and sum(places.values()) == sum(len(ids) for _, ids in want)
    assert packing.pack(docs.limit(0), BYTES).count() == 0
    joined = packing.sequences(packing.pack(docs, BYTES, most=64, with_ids=True)).collect()
    assert sum(len(r["ids"]) for r in joined) == sum(places.values()) and all(sum(r["lengths"]) == len(r["ids"]) for r in joined)


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_all_and_wastes_little(seed):
    draw = np.random.default_rng(seed)
    most = 128
    lengths = np.minimum(draw.geometric([0.01, 0.03, 0.1, 0.002][seed], 20_000), most)
    histogram = np.bincount(lengths, minlength=most + 1)
    done = packing.plan(histogram)
    used = np.zeros_like(histogram)
    for content, n in done.items():
        assert sum(content) <= most
        for length in content:
            used[length] += n
    assert (used == histogram).all()
    assert sum(done.values()) <= 1.01 * max(-(-lengths.sum() // most), (lengths > most // 2).sum()) + 1


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_text_of_special_tokens_is_that_token(path):
    texts = ["hello <|endoftext|> world", None, "<|endoftext|>", "a b <|endof", "text|> c", "x <|startoftext|><|endoftext|> y z", "plain words", "<|endoftext|>" * 3 + " end"]
    plain = Tokenizer.from_file(path)
    ids, bounds = Encoder(path).encode(texts_of(pa.array(texts)))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_words_of_letters_go_past_the_pre_tokenizer(path):
    encoder, plain = Encoder(path), Tokenizer.from_file(path)
    assert encoder.plain is not None
    words = [f"{white}{w}" for white in ("", " ", "\n", "  ") for w in ("the", "THE", "Antidisestablishmentarianism", "qzxqzx", "don", "s", "É", "a1", "x-y", "it's")]
    for w in words:
        form = encoder.plain(w.encode())
        assert form is None or encoder._merged(form) == plain.encode(w, add_special_tokens=False).ids, w


LATIN = ["é", " Été", "\nStraße", " Ñandú", "Šłż", " Нет", "ŒUVRE", " żółw", "ªº"]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_words_of_other_letters_go_past_the_pre_tokenizer(path):
    encoder, plain = Encoder(path), Tokenizer.from_file(path)
    assert [encoder.plain(w.encode()) is not None for w in LATIN if w[0] != "\n"] == [True] * (len(LATIN) - 1)
    assert all(encoder.plain(w.encode()) is None for w in ["×", " ÷", "ΣΑΣ", "İ", "é", "Ẹ́", "漢", "a b", "é1", "été."])
    for w in [*LATIN, *LETTERS, *(f" x{c}" for c in LETTERS)]:
        form = encoder.plain(w.encode())
        assert form is None or encoder._merged(form) == plain.encode(w, add_special_tokens=False).ids, w


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_letters_next_to_anything_keep_their_ids(path):
    draw, plain = random.Random(5), Tokenizer.from_file(path)
    near = [*"aBJe.,'-1 \n\t\x0b\x1c", "'s", "'S", "́", "̌", "̸", " ", "　", "×", "Σ", "İ", "ß", "漢", "—", "<|ENDOFTEXT|>"]
    texts = [a + c + b for c in LETTERS for a, b in [draw.choices(["", *near], k=2)]] + [a + b + c for a in near for b in near for c in ("é", "J", "Éa", "1")]
    texts += ["".join(draw.choice(near if draw.random() < 0.6 else LETTERS) for _ in range(12)) for _ in range(2000)]
    ids, bounds = Encoder(path).encode(texts_of(pa.array(texts)))
    for i, text in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_words_are_learnt_once_whatever_their_case_and_white_space():
    encoder = Encoder(WORDS)
    encoder.encode(texts_of(pa.array([" école the\nThe THE\tthe, the. école; école!", " J̌ Jé"])))
    assert sorted(encoder.known) == sorted(w.encode() for w in [" école", " the", ",", ".", ";", "!", " J̌", " jé"])
