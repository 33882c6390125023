"""Whether a text ends where a text may end: likelihood ratio of two n-gram models over the shapes of its last tokens."""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import cache

from inkmill.llm.lang_samples import SAMPLES

ORDER = 3
_TAIL = 12
_TOKEN = re.compile(r"\n\s*|[^\W\d_]+(?:['’][^\W\d_]+)*|\d+|[^\w\s]|_")
#: Markup and invisible characters that may follow the last sentence.
_TRAILING = re.compile(r"(?:\s|</?\w+[^<>]*>|[*_`#~​‌‍﻿ ])+\Z")
_CLOSING = set("\"'”’»«)]}›‹")
_SENTENCE = re.compile(r"(?<=[.!?…])[\"'”’»«)]*\s+|\n")
#: An address of the web or of mail that ends a text.
_ADDRESS = re.compile(r"(?:https?://|www\.|\S+@\w)\S*\w/?\Z")
_OPENING = re.compile(r"(?<!\S)[\"“«»„(](?=\s?\w)")


def stripped(text: str) -> str:
    """The text without markup, blanks and invisible characters at its end."""
    return _TRAILING.sub("", text)


def _unpointed(text: str) -> bool:
    """Whether it is written in three or more short lines, none of which has a mark at its end: verse or a list of names,
    where a last line without one says nothing."""
    lines = [line.strip() for line in text.split("\n") if line.strip()]
    return len(lines) >= 3 and all(len(line.split()) <= 9 and (line[-1].isalnum()) for line in lines)


def _open_mark(text: str) -> bool:
    """Whether the last sentence opens a quotation or bracket and does not close it."""
    last = _SENTENCE.split(text)[-1]
    opened = [m.end() for m in _OPENING.finditer(last) if m.group() != "»" or "«" not in last[: m.start()]]
    return bool(opened) and not any(c in _CLOSING or c == "“" for c in last[opened[-1] :] if c not in "'’")


def shapes(text: str) -> list[str]:
    """Shapes of the last tokens of a text: a word, A capitalised, X capitals, 9 number, marks, line ends.

    ! stands for . ! ? and …, q for closing quotes, C, for a short line that ends in a comma, ( for an open quotation.
    """
    text = stripped(text)
    tail = text[-400:]
    lines = tail.split("\n")
    out: list[str] = []
    for n, line in enumerate(lines):
        words = _TOKEN.findall(line)
        if n:
            out.append("\n")
        if n and n >= len(lines) - 3 and 1 < len(words) <= 6 and words[-1] == "," and words[0][0].isupper():
            out.append("C,")
            continue
        for w in words[-_TAIL:]:
            if w[0].isalpha():
                out.append("X" if len(w) > 1 and w.isupper() else "A" if w[0].isupper() else "a")
            elif w[0].isdigit():
                out.append("9")
            elif w in ".!?…":
                out.append("!")
            elif w in _CLOSING:
                out.append("q")
            else:
                out.append(w)
    if _open_mark(text):
        out.append("(")
    return [*out[-_TAIL:], "END"]


def _labelled() -> tuple[list[str], list[str]]:
    """Complete and cut texts made from the sample passages: whole sentences with and without a quotation mark, a
    signature, a closing line or a list before them; and the same sentences stopped after any of their words."""
    whole, cut = [], []
    for text in SAMPLES.values():
        sentences = [s.strip() for s in re.split(r"(?<=[.!?]) |\n", text) if len(s.split()) > 3]
        sentences = [s for s in sentences if s[-1] in ".!?"]
        for i, s in enumerate(sentences):
            before = sentences[i - 1]
            words = s.split()
            whole += [f"{before} {s}", f"{before}\n\n{s}", f'{before} "{s}"', f"{before}\n4. {s}", f"{before}\n- {s}"]
            whole += [f"{s}\n\nYours ever,\nAnna", f"{s}\n\nWith love,\nAnna Berg", f"{s}\n\nTHE END", f"{s}\n\nEnd.", f"{s}\n\n(end of part {i})", f"{s}…"]
            for k in range(1, len(words)):
                begun = " ".join(words[:k])
                cut += [f"{before} {begun}", f'{before} "{begun}', f"{before}\n5. {begun}", f"{before}\n\n{begun}"]
            # a stop where a comma stood, or before the first word of the next entry
            cut += [f"{before} {' '.join(words[: len(words) // 2])},", f"{s}\n{i + 2}.", f"{s}\n-", f'{before} "{s}', f"{s} —", f"{s} ({words[0]}"]
    return whole, cut


def _grams(tokens: list[str]) -> list[tuple[str, ...]]:
    padded = ["^"] * (ORDER - 1) + tokens
    # the grams that reach the end: what precedes it is the same running text in both models
    return [tuple(padded[-n:]) for n in range(2, ORDER + 2) if len(padded) >= n]


@cache
def _models() -> tuple[Counter, Counter, int, int]:
    whole, cut = _labelled()
    return Counter(g for t in whole for g in _grams(shapes(t))), Counter(g for t in cut for g in _grams(shapes(t))), len(whole), len(cut)


def cut_score(text: str) -> float:
    """Log likelihood ratio of the end of a text, cut against complete; above 0 the text seems cut off.

    The longest gram before the end that training saw decides; shorter ones serve as back-off. A text in short lines
    without any marks, and one that ends in an address, tell nothing.
    """
    if _unpointed(stripped(text)) or _ADDRESS.search(stripped(text)):
        return 0.0
    whole, cut, n, m = _models()
    grams = _grams(shapes(text))
    for gram in reversed(grams):
        a, b = whole[gram], cut[gram]
        if a + b >= 3:
            return math.log((b + 0.5) / m) - math.log((a + 0.5) / n)
    return 0.0
