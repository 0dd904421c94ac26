"""Token ids of whole texts by a public tokenizer file, with the ids of frequent words remembered."""

from __future__ import annotations

import codecs
import os
import re
import unicodedata
from itertools import chain, repeat

import numpy as np

from gridloom.llm.text import IS_WHITE, WHITE, Texts, numbered

# Words whose ids a Python worker remembers, and bytes and ids it keeps for them, before it forgets the rarer half.
MAX_WORDS, MAX_BYTES, MAX_IDS = 150_000, 4_000_000, 1_500_000

# A word of plain letters is one pre-token of the tokenizers used here. What it is before the merges, for each kind of
# tokenizer: in lower case without white space, or with its one space; then the byte-level sign of each of its bytes.
MIXED = ["word,", " x-y", "(Two) and", "a1b 22c", "end.\nNext", "-- 'tis", "3.5%", "\u00c9t\u00e9, l'\u00c9t\u00e9", "\u00f1(\u00e41\u00df)", "\u0434\u0430. \u041d\u0435\u0442!"]
PROBES = ["a", "Of", " the", " Quickly", "zzzqqxj", " iii", "\nBreak", "  two", " Straightforwardness", "\u00e9", " \u00c9t\u00e9", "\nStra\u00dfe", " \u00d1and\u00fa", "\u0160\u0142\u017c", " \u041d\u0435\u0442"]

# Distinct words handed to the tokenizer at once.
GROUP = 4_000


# Letters, digits and signs of ASCII; an apostrophe is none of them, as it may begin a contraction.
KINDS = np.zeros(256, dtype=np.uint8)
KINDS[[*range(65, 91), *range(97, 123)]] = 1
KINDS[48:58] = 2
KINDS[[b for b in range(33, 127) if not chr(b).isalnum() and b != 39]] = 3


def is_plain(letter: str) -> bool:
    """Whether it is a letter since Unicode 3.2 that composition leaves as it is, and its lower case too, with as many bytes. Not
    the sigma, whose lower case follows its place in Python alone."""
    known = unicodedata.ucd_3_2_0
    forms = {letter, letter.lower()}
    plain = all(len(c) == 1 and known.category(c)[0] == "L" and unicodedata.is_normalized("NFC", c) for c in forms)
    return plain and len({len(c.encode()) for c in forms}) == 1 and letter != "\u03a3"


# Letters of one or two bytes.
LETTERS = "".join(filter(is_plain, map(chr, range(0x800))))
PAIRS = np.zeros(1 << 16, dtype=bool)  # by both bytes of a letter
PAIRS[[int.from_bytes(c.encode(), "big") for c in LETTERS if ord(c) >= 0x80]] = True

PLAIN = re.compile(f"[{LETTERS}]+")

# The byte-level sign of each byte: itself if it is printable Latin-1, else the next character from U+0100 on.
PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
SIGNS = "".join(chr(b) if b in PRINTABLE else chr(256 + sum(x not in PRINTABLE for x in range(b))) for b in range(256))

# Bytes in one form for tokenizers that know neither case nor kinds of white space.
FOLDED = np.arange(256, dtype=np.uint8)
FOLDED[65:91] += 32
FOLDED[list(WHITE)] = 0x20


def is_pair(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a letter of two bytes begins at each of some places."""
    after = data[np.minimum(at + 1, len(data) - 1)]
    return PAIRS[(data[at].astype(np.uint16) << 8) | after]


def kinds_of(data: np.ndarray) -> np.ndarray:
    """1 letter, 2 digit, 3 sign, 0 anything that may be part of something else; both bytes of a letter have its kind."""
    kind = KINDS[data]
    at = np.flatnonzero(data >= 0xC2)
    at = at[is_pair(data, at)]
    kind[at] = kind[at + 1] = 1
    return kind


def folded(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, but for those that a mark may follow (it may be one with the small letter alone), and all white
    space as spaces."""
    out = FOLDED[data]
    at = np.flatnonzero((data[:-1] >= 65) & (data[:-1] <= 90) & (data[1:] >= 0x80))
    at = at[~is_pair(data, at + 1)]
    out[at] = data[at]
    return out


def safe_starts(data: np.ndarray, bounds: np.ndarray, kinds: bool = False) -> np.ndarray:
    """Places where a text may be cut without a change of its ids: before white space that follows
    something that is certainly none, and where a text begins; with ``kinds`` between plain letters, ASCII digits and signs too.

    Pre-tokens of the byte-level and the word tokenizers never reach from solid text into white space, and a run of
    white space stays in one piece with the word after it. Bytes that may end a Unicode space are no such place.
    """
    white = IS_WHITE[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    if len(data) > 1:
        before = data[:-1]
        cut[1:-1] = white[1:] & ~white[:-1] & ((before < 0x1C) | (before > 0x1F))
        at = np.flatnonzero(cut[1:-1] & (before >= 0x80)) + 1
        two = data[np.maximum(at - 2, 0)]
        three = data[np.maximum(at - 3, 0)]
        cut[at[(two == 0xC2) | ((three >= 0xE1) & (three <= 0xE3))]] = False
        if kinds:
            kind = kinds_of(data)
            cut[1:-1] |= (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
    cut[bounds[:-1]] = True
    return np.flatnonzero(cut[:-1])


def signs(word: bytes) -> str:
    return codecs.charmap_decode(word, "strict", SIGNS)[0]


def lowered(word: bytes) -> str | None:
    bare = word.strip()
    if bare.isalpha():
        return bare.lower().decode()
    letters = bare.decode()
    return signs(letters.lower().encode()) if PLAIN.fullmatch(letters) else None


def spaced(word: bytes) -> str | None:
    bare = word.removeprefix(b" ")
    return signs(word) if bare.isalpha() or PLAIN.fullmatch(bare.decode()) else None


class Encoder:
    """Ids of texts; equal words of any texts are encoded once as long as they are remembered."""

    _made: dict[str, Encoder] = {}

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # only a way that gives the library's ids for all probes is taken
        self.plain = next((way for way in (lowered, spaced) if all(self._agrees(way(w.encode()), w) for w in PROBES)), None)
        self.kinds = all(self._splits(w) for w in MIXED)
        self.folds = self.plain is lowered and self.kinds and all(self._folds(w) for w in [*MIXED, *PROBES, *(chr(w) + "A\u00e9" for w in WHITE)])
        # no word then becomes the text of a special token
        self.folds = self.folds and all(len(safe_starts(np.frombuffer(t, np.uint8), np.array([0, len(t)]), True)) > 1 for t in self.special)
        self.forget()

    def _splits(self, word: str) -> bool:
        """Whether the ids of a text are those of its pieces."""
        raw = word.encode()
        cuts = [*safe_starts(np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)]), True).tolist(), len(raw)]
        parts = [self.tokenizer.encode(raw[a:b].decode(), add_special_tokens=False).ids for a, b in zip(cuts, cuts[1:])]
        return [x for part in parts for x in part] == self.tokenizer.encode(word, add_special_tokens=False).ids

    def _folds(self, word: str) -> bool:
        form = folded(np.frombuffer(word.encode(), dtype=np.uint8)).tobytes().decode()
        return self.tokenizer.encode(form, add_special_tokens=False).ids == self.tokenizer.encode(word, add_special_tokens=False).ids

    def _agrees(self, form: str | None, word: str) -> bool:
        return form is None or self._merged(form) == self.tokenizer.encode(word, add_special_tokens=False).ids

    def _merged(self, form: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(form)]

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.held = 0  # bytes of the words
        self.ids = np.zeros(1 << 16, dtype=np.int32)
        self.stops = np.zeros(1 << 16, dtype=np.int64)  # of word w: ids[stops[w]:stops[w + 1]]
        self.uses = np.zeros(1 << 16, dtype=np.int32)  # in how many slices, halved when words are forgotten

    def forget_rare(self) -> None:
        """Keep the more used half of the words (none if they hold too many ids)."""
        words, ids, stops, uses = list(self.known), self.ids, self.stops, self.uses
        kept = np.sort(np.argsort(-uses[: len(words)], kind="stable")[: MAX_WORDS // 2])
        lengths = stops[kept + 1] - stops[kept]
        self.forget()
        if lengths.sum() > MAX_IDS // 2:
            return
        ends = np.cumsum(lengths)
        self.ids = ids[np.repeat(stops[kept] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]
        self.stops = np.concatenate([[0], ends])
        self.uses = uses[kept] // 2
        self.known = {words[k]: i for i, k in enumerate(kept.tolist())}
        self.held = sum(map(len, self.known))

    def _found(self, words: list[bytes]) -> list[list[int]]:
        """The ids of some words: those of plain letters by the merges alone, all others by the whole tokenizer."""
        if self.plain is None:
            return [e.ids for e in self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)]
        forms, tokenize = list(map(self.plain, words)), self.tokenizer.model.tokenize
        others = iter(self.tokenizer.encode_batch_fast([w.decode() for w, f in zip(words, forms, strict=True) if f is None], add_special_tokens=False))
        return [next(others).ids if f is None else [t.id for t in tokenize(f)] for f in forms]

    def _learn(self, words: list[bytes]) -> None:
        at = len(self.known)
        for i in range(0, len(words), GROUP):
            group = words[i : i + GROUP]
            found = self._found(group)
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            end = self.stops[at]
            total = int(end + lengths.sum())
            if total > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(max(total, len(self.ids)), np.int32)])
            if at + len(group) + 1 > min(len(self.stops), len(self.uses)):
                self.stops = np.concatenate([self.stops, np.zeros(max(len(group) + 1, len(self.stops)), np.int64)])
                self.uses = np.concatenate([self.uses, np.zeros(max(len(group) + 1, len(self.uses)), np.int32)])
            self.ids[end:total] = np.fromiter(chain.from_iterable(found), np.int32, total - int(end))
            self.stops[at + 1 : at + 1 + len(group)] = end + np.cumsum(lengths)
            self.known.update(zip(group, range(at, at + len(group)), strict=True))
            at += len(group)
        self.held += sum(map(len, words))

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and the bounds of each text in them. The text of a special token inside a text is that
        token, as the library has it; a text with one is encoded as a whole."""
        odd = self._with_special(texts)
        if not odd:
            return self._encode(texts)
        sizes = np.diff(texts.bounds)
        kept = np.repeat(~np.isin(np.arange(len(texts)), odd), sizes)
        sizes[odd] = 0
        ids, bounds = self._encode(Texts(texts.data[kept], np.concatenate([[0], np.cumsum(sizes)])))
        parts = [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        for i in odd:
            parts[i] = np.array(self.tokenizer.encode(texts.raw(i).decode(), add_special_tokens=False).ids, dtype=np.int32)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def _with_special(self, texts: Texts) -> list[int]:
        """The numbers of the texts that hold the text of a special token."""
        raw, odd = texts.data.tobytes(), set()
        for token in self.special:
            at = raw.find(token)
            while at >= 0:
                i = int(np.searchsorted(texts.bounds, at, "right")) - 1
                if at + len(token) <= texts.bounds[i + 1]:
                    odd.add(i)
                    at = raw.find(token, int(texts.bounds[i + 1]))
                else:
                    at = raw.find(token, at + 1)
        return sorted(odd)

    def _encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > MAX_WORDS or self.held > MAX_BYTES or self.stops[len(self.known)] > MAX_IDS:
            self.forget_rare()
        starts = safe_starts(texts.data, texts.bounds, self.kinds)
        data = folded(texts.data) if self.folds else texts.data
        numbers, distinct = numbered(data, np.append(starts, len(data))) if len(data) else (np.zeros(0, np.int64), None)
        words = distinct.to_pylist() if distinct is not None else []
        places = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(places < 0)
        places[new] = len(self.known) + np.arange(len(new))
        self._learn([words[i] for i in new.tolist()])
        self.uses[places] += 1
        known = places[numbers] if words else numbers
        first, lengths = self.stops[known], self.stops[known + 1] - self.stops[known]
        stops = np.concatenate([[0], np.cumsum(lengths)])
        at = np.arange(stops[-1], dtype=np.int32)  # a slice has fewer ids than 2 ** 31
        at += np.repeat((first - stops[:-1]).astype(np.int32), lengths)
        return self.ids[at], stops[np.searchsorted(starts, texts.bounds)]


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after each text."""
    out = np.full(len(ids) + len(bounds) - 1, end_id, dtype="<u4")
    moved = bounds + np.arange(len(bounds))
    put = np.ones(len(out), dtype=bool)
    put[moved[1:] - 1] = False
    out[put] = ids
    return out, moved
