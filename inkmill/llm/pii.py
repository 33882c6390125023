"""Problem 10: personal data in free text, tagged by a linear-chain conditional random field.

The field is trained on the labelled table of ``pii_table`` over word shapes, word lists and neighbours. Stretches of
a text that could hold personal data (around digits, at-signs and capitalised neighbours) are decoded by Viterbi, all
stretches of a batch side by side; elsewhere only the outside label is possible. The field decides what a span is; its
first and last character are then set by its type.
"""

from __future__ import annotations

import base64
import hashlib
import inspect
import itertools
import random
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm import crf, pii_table
from inkmill.llm.encoding import TOKENIZERS
from inkmill.llm.pii_table import FAMILY, GIVEN, PLACES, TYPES, labelled_table
from inkmill.llm.wordstream import chunks, mix, powers

LABELS = ("O", *(f"{p}-{t}" for t in TYPES for p in "BI"))
GAPS = 4  # none, blank, several blanks, start of a line
REACH = 5
#: Public vocabularies that tell ordinary words.
VOCABULARIES = ("byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken")
#: Most name forms that are held in memory; the check is made before they are sent to the executors.
MAX_NAME_FORMS = 500_000
_SKIP, _LETTER, _DIGIT, _LINE, _MARK = range(5)
_tables: dict[str, np.ndarray] = {}


def _char_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not _tables:
        size = 0x20000
        kind, upper = np.full(size + 1, _MARK, np.uint8), np.zeros(size + 1, bool)
        for i in range(size):
            c = chr(i)
            category = unicodedata.category(c)
            if c in "\n\r":
                kind[i] = _LINE
            elif c.isspace() or category in ("Cc", "Cf"):
                kind[i] = _SKIP
            elif category[0] in "LM":
                kind[i] = _LETTER
                upper[i] = c.isupper()
            elif category == "Nd":
                kind[i] = _DIGIT
        _tables.update(kind=kind, upper=upper, code=mix(np.arange(1, size + 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    return _tables["kind"], _tables["upper"], _tables["code"]


class Tokens:
    """Tokens of a batch of texts: runs of letters, runs of digits, single marks; with the gap before each."""

    def __init__(self, texts: list[str]) -> None:
        kinds, upper, codes = _char_tables()
        self.joined = "\n".join([*texts, ""])
        chars = np.minimum(np.frombuffer(self.joined.encode("utf-32-le", "surrogatepass"), np.uint32), 0x20000)
        kind = kinds[chars]
        begin = np.concatenate(([True], kind[1:] != kind[:-1])) | (kind == _MARK)
        first = np.flatnonzero(begin)
        last = np.append(first[1:], len(chars))
        real = (kind[first] != _SKIP) & (kind[first] != _LINE)
        # what lies between two tokens
        cut = np.cumsum(kind == _LINE)
        self.first, self.last, self.kind = first[real], last[real], kind[first[real]]
        before = np.concatenate(([0], self.last[:-1]))
        space = self.first - before
        line = cut[self.first] != np.concatenate(([-1], cut[self.last[:-1] - 1]))
        self.gap = np.where(line, 3, np.minimum(space, 2)).astype(np.int64)
        self.capital = upper[chars[self.first]] & (self.kind == _LETTER)
        self.char = chars[self.first]
        up, down = powers(len(chars) + 1)
        total = np.zeros(len(chars) + 1, np.uint64)
        np.cumsum(codes[chars] * up[: len(chars)], out=total[1:])
        self.hash = mix((total[self.last] - total[self.first]) * down[self.first] + (self.last - self.first).astype(np.uint64))
        self.offset = np.cumsum([0, *(len(t) + 1 for t in texts)])

    def text(self, i: int) -> str:
        return self.joined[self.first[i] : self.last[i]]

    def places(self, shapes: dict[str, int]) -> np.ndarray:
        """What holds for a token at its place: the gap before it, and the shape of the number that it is part of."""
        out = self.gap.copy()
        for m in _NUMBERS.finditer(self.joined):
            shape = number_shape(m.group())
            known = shapes.get(shape) or shapes.get(shape.removeprefix("0:")) or loose_shape(shape)
            out[np.searchsorted(self.first, m.start()) : np.searchsorted(self.first, m.end())] += GAPS * known
        return out


#: Digits with what may stand within and around a number: separators, a plus or bracket before, single capitals.
_NUMBERS = re.compile(r"\b[A-Z]{2} ?\d\d ?\d\d ?\d\d ?[A-Z]\b|\b[XYZ]-?\d{7}-?[A-Z]\b|[+(]{0,2}\d(?:[\d()/ \u00a0.-]*\d)?(?:[ -]?[A-Z]\b)?")
_DIGITS, _CAPITAL = re.compile(r"\d+"), re.compile(r"[A-Z]")
#: Classes of numbers whose shape is not known by itself: two kinds of beginning and six of length.
LOOSE = 12


def number_shape(number: str) -> str:
    """A number with its runs of digits as their lengths, 0 first where it begins with one; capitals as A."""
    if number.count("(") > number.count(")"):
        number = number.replace("(", "", 1)
    shape = _DIGITS.sub(lambda m: str(len(m.group())), _CAPITAL.sub("A", number.replace("\u00a0", " ")))
    return ("0:" if number.lstrip("(+")[:1] == "0" else "") + shape


def loose_shape(shape: str) -> int:
    """1 to LOOSE, by how a number begins and how many digits it has."""
    digits = sum(map(int, _DIGITS.findall(shape.removeprefix("0:"))))
    return 1 + 6 * (shape[0] in "0+(") + int(np.searchsorted((6, 8, 10, 12, 16), digits, "right"))


#: Ends of German street names, and street words of four languages (fixed values).
STREET_ENDS = ("straße", "strasse", "gasse", "weg", "platz", "str", "allee", "ufer", "ring", "damm", "steig")
STREETS = frozenset(
    """street st road rd lane ln avenue ave drive dr close court ct way grove place terrace crescent gardens hill row walk mews square park boulevard blvd green rise view parade quay
    rue quai allée chemin impasse cours passage route bis ter calle avenida avda plaza paseo camino ronda travesía am auf zum zur unter flat""".split()
)
TITLES = frozenset("mr mrs ms miss dr prof professor sir herr herrn frau mme mlle madame monsieur señor señora sr sra don doña doktor doctor captain judge nurse".split())
PARTICLES = frozenset("de la von van del di da du dos le al el bin ben mac mc san st zu y ibn".split())
#: What is taken off the score of the outside label: a doubtful span is kept.
OUTSIDE_PENALTY = 1.0
#: Of this, what is taken off the scores of the types that prose resembles too much.
DOUBTFUL = {"address": 0.4, "name": 0.3}
#: Most features of a token.
WIDTH = 8


class Lists:
    """What a token is looked up in: known given and family names in lower case, and the words that the public vocabularies
    hold whole, as they are written after a blank."""

    def __init__(self, given: object, family: object, words: object) -> None:
        self.given, self.family, self.words = given, family, words


def vocabulary(folder: str = TOKENIZERS) -> frozenset[str]:
    """The words of letters that a public vocabulary (of English, of many languages) has as one entry after a blank."""
    found = set()
    for name in VOCABULARIES:
        with open(f"{folder}/{name}", "rb") as f:
            for line in f:
                piece = base64.b64decode(line.split()[0])
                if piece[:1] == b" ":
                    word = piece[1:].decode("utf-8", "ignore")
                    if len(word) > 1 and word.isalpha():
                        found.add(word)
    return frozenset(found)


def token_features(token: str, lists: Lists) -> list[str]:
    """Features of a token: shape and size, the word itself, whether it is an ordinary word, a known name, a street word."""
    if token[0].isdigit():
        return [f"n{min(len(token), 16)}", f"n0{min(len(token), 16)}" if token[0] == "0" else "n+", "year" if len(token) == 4 and token[:2] in ("17", "18", "19", "20") else "n?"]
    if not unicodedata.category(token[0])[0] in "LM":
        return [f"m{token}"]
    low = token.lower()
    size = "1" if len(token) == 1 else "2" if len(token) == 2 else "+"
    shape = "X" if token.isupper() else "Xx" if token[0].isupper() else "x" if token.islower() else "xX"
    # an ordinary word is known in small letters, a name often with a capital alone
    known = ("l" if low in lists.words else "") + ("c" if token.capitalize() in lists.words else "")
    out = [f"s{shape}{size}", f"w{low}", f"k{shape}{known}"]
    if low in STREETS:
        out.append("street")
    elif len(low) > 5 and low.endswith(STREET_ENDS):
        out.append("streetend")
    if low in TITLES:
        out.append("title")
    if low in PARTICLES:
        out.append(f"particle{shape}")
    out += [f"g{shape}"] * (low in lists.given) + [f"f{shape}"] * (low in lists.family)
    return out[:WIDTH]


def feature_rows(tokens: Iterable[str], index: dict[str, int], lists: Iterable[Lists]) -> np.ndarray:
    """Feature numbers of each token, padded with 0, which stands for no feature. An empty token has none."""
    rows = [[index[f] for f in (token_features(w, held) if w else ()) if f in index] for w, held in zip(tokens, lists)]
    out = np.zeros((len(rows), WIDTH), np.int64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


class Tagger:
    """The trained field with the feature rows and scores of the token types seen so far."""

    def __init__(self, given: object, family: object, trained: tuple | None = None) -> None:
        self.index, self.shapes, self.model, words = trained or model()
        self.lists = Lists(given, family, words)
        self._forget()

    def _forget(self) -> None:
        self.number: dict[int, int] = {}
        self.scores = np.zeros((len(crf.OFFSETS), 1 << 12, len(LABELS)), np.float32)
        self.used = 1  # 0 pads

    def types(self, tokens: Tokens) -> np.ndarray:
        """Type numbers of all tokens; scores of new types are added."""
        if self.used > 300_000:
            self._forget()
        different, at, which = np.unique(tokens.hash, return_index=True, return_inverse=True)
        numbers, fresh = np.empty(len(different), np.int64), []
        for k, h in enumerate(different.tolist()):
            n = self.number.get(h)
            if n is None:
                n = self.number[h] = self.used + len(fresh)
                fresh.append(int(at[k]))
            numbers[k] = n
        if fresh:
            rows = feature_rows((tokens.text(i) for i in fresh), self.index, itertools.repeat(self.lists))
            while self.used + len(fresh) > self.scores.shape[1]:
                self.scores = np.concatenate((self.scores, np.zeros_like(self.scores)), axis=1)
            self.scores[:, self.used : self.used + len(fresh)] = crf.token_scores(self.model, rows)
            self.used += len(fresh)
        return numbers[which]

    def tag(self, texts: list[str]) -> list[list[tuple[str, int, int]]]:
        """(type, start, end) of the personal data in each text."""
        t = Tokens(texts)
        found: list[list[tuple[str, int, int]]] = [[] for _ in texts]
        begins, lengths = stretches(t)
        if not len(begins):
            return found
        inside = np.zeros(len(t.first) + 1, np.int64)
        np.add.at(inside, begins, 1)
        np.add.at(inside, begins + lengths, -1)
        inside = np.flatnonzero(np.cumsum(inside)[:-1] > 0)
        types = self.types(t)
        reach = max(crf.OFFSETS)
        padded = np.concatenate((np.zeros(reach, np.int64), types, np.zeros(reach, np.int64)))
        score = self.model.gap.astype(np.float32)[t.places(self.shapes)[inside]]
        for k, o in enumerate(crf.OFFSETS):
            score = score + self.scores[k][padded[inside + reach + o]]
        score += _BIAS
        at = np.searchsorted(inside, begins)
        label = crf.viterbi(score, at, lengths, self.model.move, self.model.allowed, _START)
        hot = np.flatnonzero(label)
        k = 0
        while k < len(hot):
            i, e = hot[k], k + 1
            kind = (label[i] - 1) // 2
            while e < len(hot) and hot[e] == hot[e - 1] + 1 and inside[hot[e]] == inside[hot[e - 1]] + 1 and label[hot[e]] == 2 * kind + 2:
                e += 1
            a, b = int(t.first[inside[i]]), int(t.last[inside[hot[e - 1]]])
            doc = int(np.searchsorted(t.offset, a, "right")) - 1
            base = int(t.offset[doc])
            found[doc] += settle(TYPES[kind], texts[doc], a - base, b - base)
            k = e
        return [merged(f) for f in found]


def stretches(t: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """(first token, length) of the runs of tokens that could hold personal data, REACH tokens wide on both sides.

    Every type needs a digit, an at-sign (or its spelling in brackets or between words) or two capitalised words
    close together; runs never cross a line end.
    """
    n = len(t.first)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    hot = (t.kind == _DIGIT) | (t.char == 64)
    at = (t.kind == _LETTER) & (t.last - t.first == 2) & np.isin(t.char, [97, 65])
    for i in np.flatnonzero(at):
        hot[i] = t.text(i).lower() == "at"
    for d in (1, 2):
        near = t.capital[:-d] & t.capital[d:] if d < n else np.empty(0, bool)
        hot[: len(near)] |= near
        hot[d : d + len(near)] |= near
    line = np.cumsum(t.gap == 3)
    places = np.flatnonzero(hot)
    if not len(places):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    starts = np.searchsorted(line, line[places], "left")
    ends = np.searchsorted(line, line[places], "right")
    a, b = np.maximum(places - REACH, starts), np.minimum(places + REACH + 1, ends)
    new = np.concatenate(([True], (a[1:] > b[:-1]) | (line[places[1:]] != line[places[:-1]])))
    group = np.flatnonzero(new)
    begin = a[group]
    end = np.maximum.reduceat(b, group)
    return begin, end - begin


#: What belongs to an address of mail, and to a phone number, next to what was found.
_MAIL, _DIAL = frozenset(".+%-_'"), frozenset("+(0123456789")
_AT = re.compile(r"\s*[(\[{]?\s*(?:@|\bat\b)", re.IGNORECASE)
_SENTENCE_END = re.compile(r"(?<=[a-zß-ÿ]{4})[.!?]\s+(?=[^\W\d_a-zß-ÿ])")
_NUMBER = re.compile(r"(?<![\w/.-])\d{1,5}\s?[A-Za-z]?(?:\s?[-/]\s?\d{1,5}[A-Za-z]?)?(?:\s(?:bis|ter))?,?\s+\Z", re.IGNORECASE)
#: Words of two letters or more; a dot ends a name unless it follows an initial.
_NAME_WORD, _NAME_PART = re.compile(r"[^\W\d_]{2,}"), re.compile(r"(?:[^.\n\r]|(?<=\b\w)\.|(?<=\bSt)\.)+")


#: Digits that a phone number has at least; digits and letters of an identity number.
LEAST_DIGITS, LEAST_SIGNS = 7, 8


def settle_name(text: str, a: int, b: int) -> list[tuple[str, int, int]]:
    """Places of full names in a span: it is cut where a sentence ends, titles and small words before them go, single names don't count."""
    out = []
    for part in _NAME_PART.finditer(text, a, b):
        s, e = part.span()
        while s < e and not text[s].isalpha():
            s += 1
        while e > s and not text[e - 1].isalpha():
            e -= 1
        words = _NAME_WORD.findall(text, s, e)
        while words and (words[0].lower() in TITLES or words[0].islower() and "," not in text[s:e]):
            s = text.index(words[0], s) + len(words[0])
            while s < e and not text[s].isalpha():
                s += 1
            words = words[1:]
        if len(words) >= 2:
            out.append(("name", s, e))
    return out


def settle(kind: str, text: str, a: int, b: int) -> list[tuple[str, int, int]]:
    """The places of a decoded span; the field decides what it is, here its ends are set.

    A span that can't be of its type by definition goes: a number that is too short, an address without a number or
    without a street, an address of mail without an at, a name of one word.
    """
    if kind == "name":
        return settle_name(text, a, b)
    while a < b and not (text[a].isalnum() or kind == "phone" and text[a] in "+("):
        a += 1
    while b > a and not (text[b - 1].isalnum() or kind == "address" and text[b - 1] == "."):
        b -= 1
    if kind == "email":
        at = _AT.search(text, a, b)
        if not at:
            return []
        a = at.start()
        while a and (text[a - 1].isalnum() or text[a - 1] in _MAIL):
            a -= 1
        while a < at.start() and not text[a].isalnum():
            a += 1
        while b < len(text) and text[b].isalnum():
            b += 1
        return [(kind, a, b)] if a < at.start() else []
    if kind == "address":
        if m := _NUMBER.search(text, max(0, a - 16), a):
            a = m.start()
        room = text[b : b + 8]
        if not any(c.isdigit() for c in text[a:b]) and (m := re.match(r"[.,]?\s(?:n\S{0,3}\s?)?\d{1,5}\b", room)):
            b += m.end()
        if m := _SENTENCE_END.search(text, a, b):
            b = m.start() + 1
        words = _NAME_WORD.findall(text, a, b)
        street = any(w[0].isupper() or w.lower() in STREETS or w.lower().endswith(STREET_ENDS) for w in words)
        return [(kind, a, b)] if street and any(c.isdigit() for c in text[a:b]) else []
    while a and (text[a - 1].isalnum() if kind == "id_number" else text[a - 1] in _DIAL):
        a -= 1
    while b < len(text) and text[b].isalnum() and (kind == "id_number" or text[b].isdigit()):
        b += 1
    # a bracket that closes behind the number, or nowhere, stands around it
    while a < b and text[a] == "(" and not any(map(str.isdigit, text[a:b].partition(")")[2])):
        a += 1
    return [(kind, a, b)] if (sum(map(str.isdigit, text[a:b])) >= LEAST_DIGITS if kind == "phone" else sum(map(str.isalnum, text[a:b])) >= LEAST_SIGNS) else []


def merged(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans in order; of two that overlap the first stays, a name inside an email address goes."""
    out: list[tuple[str, int, int]] = []
    for s in sorted(spans, key=lambda s: (s[1], -s[2])):
        if not out or s[1] >= out[-1][2]:
            out.append(s)
        elif out[-1][0] == "name" and s[0] != "name":
            out[-1] = s
    return out


_BIAS = np.array([-OUTSIDE_PENALTY if x == "O" else -DOUBTFUL.get(x[2:], 0.0) for x in LABELS], np.float32)
_START = np.array([not x.startswith("I") for x in LABELS])
_ALLOWED = np.array([[not b.startswith("I") or a[2:] == b[2:] and a != "O" for b in LABELS] for a in LABELS])


#: Share of the names that count as known in a sentence; the rest must be told by their looks and by what is around them.
LISTED = 0.5
#: The trained weights, written by ``python -m inkmill.llm.pii`` and read here; with another table they are trained anew.
WEIGHTS = Path(__file__).with_name("pii_weights.npz")


def training_rows(words: frozenset[str]) -> tuple[list, np.ndarray, dict[str, int], dict[str, int]]:
    """Sentences as (token types, places, labels), the feature rows of the types, the numbers of features and of shapes."""
    table, names = labelled_table()
    r = random.Random(5)
    rows = []
    for parts in table:
        t = Tokens(["".join(p for p, _ in parts)])
        labels, at = np.zeros(len(t.first), np.int64), 0
        for part, kind in parts:
            own = np.flatnonzero((t.first >= at) & (t.first < at + len(part)))
            if kind and len(own):
                labels[own] = 2 * TYPES.index(kind) + 2
                labels[own[0]] -= 1
            at += len(part)
        if len(t.first):
            rows.append(([t.text(i) for i in range(len(t.first))], t, labels))
    seen = Counter(number_shape(m.group()) for _, t, _ in rows for m in _NUMBERS.finditer(t.joined))
    shapes = {x: LOOSE + 1 + i for i, x in enumerate(sorted(x for x, n in seen.items() if n >= 4))}
    # a name is known in some sentences and in others not
    bare = Lists((), (), words)
    count = Counter(f for tokens, _, _ in rows for w in set(tokens) for f in token_features(w, bare))
    index = {f: i + 1 for i, f in enumerate(sorted([f for f, n in count.items() if f[0] != "w" or n >= 3 and f[1:] not in names] + [f"{k}{s}" for k in "gf" for s in ("X", "Xx", "x", "xX")]))}
    given, family = {n.lower() for n in GIVEN}, {n.lower() for n in FAMILY}
    types: dict[tuple[str, int], int] = {}
    sentences = []
    for tokens, t, labels in rows:
        listed = []
        for k, w in enumerate(tokens):
            in_name = labels[k] and TYPES[(labels[k] - 1) // 2] == "name"
            mark = 0
            # before a word that is also part of place names the given name is always known
            sure = in_name and not PLACES.isdisjoint(x.capitalize() for x in tokens[max(0, k - 2) : k + 4])
            if w[0].isupper() and (in_name or w.lower() in names) and (sure or r.random() < LISTED):
                first = in_name and not (k and labels[k - 1] == labels[k] or labels[k] % 2 == 0)
                mark = 1 if w.lower() in given or first and w.lower() not in family else 2
            listed.append(types.setdefault((w, mark), len(types) + 1))
        sentences.append((np.array(listed), t.places(shapes), labels))
    held = [bare, *(Lists({w.lower()} if mark == 1 else (), {w.lower()} if mark == 2 else (), words) for w, mark in types)]
    return sentences, feature_rows(["", *(w for w, _ in types)], index, held), index, shapes


def fit(words: frozenset[str]) -> tuple[dict[str, int], dict[str, int], crf.Chain]:
    sentences, features, index, shapes = training_rows(words)
    return index, shapes, crf.train(sentences, features, len(index) + 1, len(LABELS), GAPS * (LOOSE + 1 + len(shapes)), _ALLOWED)


def stamp() -> str:
    """Changes with whatever the weights depend on."""
    parts = [Path(m.__file__).read_bytes() for m in (pii_table, crf)] + [inspect.getsource(f).encode() for f in (token_features, training_rows, number_shape, loose_shape, Tokens)]
    return hashlib.sha256(b"".join(parts)).hexdigest()


@lru_cache(1)
def model(folder: str = TOKENIZERS) -> tuple[dict[str, int], dict[str, int], crf.Chain, frozenset[str]]:
    """Numbers of features and shapes, weights and vocabulary."""
    words = vocabulary(folder)
    if WEIGHTS.exists():
        with np.load(WEIGHTS) as held:
            if str(held["stamp"]) == stamp():
                names, shapes = (str(held[k]).split("\n") for k in ("names", "shapes"))
                chain = crf.Chain(len(names) + 1, len(LABELS), len(held["gap"]), _ALLOWED)
                chain.w, chain.gap, chain.move = (held[k].astype(np.float64) for k in ("w", "gap", "move"))
                return {n: i + 1 for i, n in enumerate(names)}, {x: LOOSE + 1 + i for i, x in enumerate(shapes)}, chain, words
    return *fit(words), words


def write_weights() -> None:
    index, shapes, chain = fit(vocabulary())
    names, numbers = ("\n".join(sorted(d, key=d.get)) for d in (index, shapes))
    np.savez_compressed(WEIGHTS, stamp=stamp(), names=names, shapes=numbers, w=chain.w.astype(np.float16), gap=chain.gap.astype(np.float32), move=chain.move.astype(np.float32))


def name_forms(names: DataFrame) -> tuple[frozenset[str], frozenset[str]]:
    """Known given and family names in lower case; at most MAX_NAME_FORMS rows."""
    rows = names.where("name_form is not null").select(F.lower("name_form").alias("f"), F.lower("kind").alias("k")).distinct().limit(MAX_NAME_FORMS + 1).collect()
    if len(rows) > MAX_NAME_FORMS:
        raise ValueError(f"more than {MAX_NAME_FORMS} name forms")
    return frozenset(r["f"] for r in rows if r["k"] == "given"), frozenset(r["f"] for r in rows if r["k"] == "family")


_taggers: dict[int, Tagger] = {}


def _tagger(held: object) -> Tagger:
    """One tagger for each broadcast in a process; the model comes with it, so executors don't train."""
    key = id(held.value)
    if key not in _taggers:
        trained, given, family = held.value
        _taggers.clear()
        _taggers[key] = Tagger(given, family, trained)
    return _taggers[key]


def _over(documents: DataFrame, names: DataFrame, schema: str, rows: object) -> DataFrame:
    spark = documents.sparkSession
    held = spark.sparkContext.broadcast((model(), *name_forms(names)))
    types = [pa.field(f.name, {"bigint": pa.int64(), "string": pa.string()}[f.dataType.simpleString()]) for f in spark.createDataFrame([], schema).schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = _tagger(held)
        for batch in batches:
            ids, column = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in chunks(column):
                out = [r for i, t, spans in zip(ids[a:b], column[a:b], tagger.tag([t or "" for t in column[a:b]])) for r in rows(i, t, spans)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), types)], schema=pa.schema(types))

    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, schema)


def find_personal_data(documents: DataFrame, names: DataFrame) -> DataFrame:
    """(doc_id, pii_type, start_pos, end_pos) of every place, in code points of the text.

    Null and empty texts have none; a null doc_id stays null; a document given twice has each place once. Texts of any
    length are read whole. An empty ``names`` table only takes the list features away.
    """
    found = _over(documents, names, "doc_id bigint, pii_type string, start_pos bigint, end_pos bigint", lambda i, t, spans: [(i, *s) for s in spans])
    return found.distinct()


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with [EMAIL] and the like in place of the spans."""
    out, at = [], 0
    for kind, a, b in spans:
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def redact_personal_data(documents: DataFrame, names: DataFrame) -> DataFrame:
    """(doc_id, text, places): every document with typed placeholders in its text; null texts stay null."""
    return _over(documents, names, "doc_id bigint, text string, places bigint", lambda i, t, spans: [(i, None if t is None else redact(t, spans), len(spans))])


if __name__ == "__main__":
    from inkmill.llm import pii  # the module by its own name, so that the weights belong to it

    pii.write_weights()
