"""Language posteriors from a naive Bayes over character trigrams, for many texts at once."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.llm.lang_samples import SAMPLES

LANGUAGES = tuple(SAMPLES)
#: Letters that the model tells apart; a blank stands for everything that is no letter, ? for other letters.
LETTERS = " ?abcdefghijklmnopqrstuvwxyzàâäáæçéèêëíîïñóôöœßùûüúÿ¿¡"
_SIZE = len(LETTERS)
_LIMIT = 0x3000
_model: dict[str, np.ndarray] = {}


def _place_table() -> np.ndarray:
    table = np.zeros(_LIMIT, np.int32)
    for i in range(_LIMIT):
        c = chr(i).lower()
        if c in LETTERS[2:] and len(c) == 1:
            table[i] = LETTERS.index(c)
        elif c.isalpha():
            table[i] = 1
    return table


def _trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram numbers of all texts and the text of each; runs of blanks count as one."""
    joined = "\n".join([*texts, ""])
    chars = np.minimum(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32), _LIMIT - 1)
    place = _model["place"][chars]
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    keep = (place > 0) | (np.concatenate(([1], place[:-1])) > 0)
    place, owner = place[keep], owner[keep]
    if len(place) < 3:
        return np.empty(0, np.int32), np.empty(0, np.int64)
    inside = owner[2:] == owner[:-2]
    code = (place[:-2] * _SIZE + place[1:-1]) * _SIZE + place[2:]
    # a trigram whose middle is a blank spans two words and says little
    inside &= place[1:-1] > 0
    return code[inside], owner[2:][inside]


def _train() -> None:
    _model["place"] = _place_table()
    counts = np.zeros((_SIZE**3, len(LANGUAGES)))
    for k, name in enumerate(LANGUAGES):
        code, _ = _trigrams([f" {SAMPLES[name]} "])
        counts[:, k] = np.bincount(code, minlength=_SIZE**3)
    smooth = counts + 0.15
    _model["log"] = np.log(smooth / smooth.sum(axis=0)).astype(np.float32)


def log_likelihoods(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(texts x languages) log likelihoods, and the number of trigrams behind each row."""
    if not _model:
        _train()
    texts = [f" {t or ''} " for t in texts]
    code, owner = _trigrams(texts)
    rows = _model["log"][code]
    sums = np.stack([np.bincount(owner, weights=rows[:, k], minlength=len(texts)) for k in range(len(LANGUAGES))], axis=1)
    return sums, np.bincount(owner, minlength=len(texts))


def posteriors(texts: list[str | None]) -> np.ndarray:
    """(texts x languages) posteriors under equal priors; rows without letters are uniform."""
    sums, _ = log_likelihoods(texts)
    p = np.exp(sums - sums.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


#: Scripts by ranges of code points (fixed values). Chinese and Japanese share one, as they share their characters.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x250, 0x2AF), (0x1E00, 0x1EFF), (0xFF21, 0xFF5A)], "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)], "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)], "hebrew": [(0x590, 0x5FF)], "arabic": [(0x600, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFE)], "indic": [(0x900, 0xDFF)], "thai": [(0xE00, 0xEFF)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF)], "ethiopic": [(0x1200, 0x139F)], "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "east": [(0x3005, 0x3007), (0x3040, 0x312F), (0x31A0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF)],
}
#: What a character of a script with many syllables or words in one sign counts, in letters.
_WEIGHT = {"east": 3, "hangul": 3}
_scripts: dict[str, np.ndarray] = {}


def _script_table() -> np.ndarray:
    table = np.zeros(0x40000, np.int8)
    for n, ranges in enumerate(SCRIPTS.values(), 1):
        for a, b in ranges:
            for i in range(a, b + 1):
                if i >= 0x20000 or chr(i).isalpha():
                    table[i] = n
    return table


def script_letters(texts: list[str | None]) -> np.ndarray:
    """(texts x SCRIPTS) letters of each script in each text, weighted."""
    if "table" not in _scripts:
        _scripts["table"] = _script_table()
    joined = "\n".join([*[t or "" for t in texts], ""])
    kind = _scripts["table"][np.minimum(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32), 0x3FFFF)]
    owner = np.repeat(np.arange(len(texts)), [len(t or "") + 1 for t in texts])
    n = len(SCRIPTS) + 1
    counts = np.bincount(owner * n + kind, minlength=len(texts) * n).reshape(len(texts), n)[:, 1:]
    return counts * np.array([_WEIGHT.get(name, 1) for name in SCRIPTS])


def detect(df: DataFrame, text: str = "response") -> tuple[Column, Column]:
    """(language, probability) of each text, for the language filter; null and 0 where most letters aren't Latin, or none is.

    A language other than LANGUAGES in Latin letters gets the one of them that is nearest.
    """

    @F.pandas_udf("struct<lang:string,probability:double>")
    def guess(texts: pd.Series) -> pd.DataFrame:
        held = [t or "" for t in texts]
        p, letters = posteriors(held), script_letters(held)
        latin = 2 * letters[:, list(SCRIPTS).index("latin")] > letters.sum(axis=1)
        return pd.DataFrame({"lang": [LANGUAGES[k] if ok else None for k, ok in zip(p.argmax(axis=1), latin)], "probability": np.where(latin, p.max(axis=1), 0.0)})

    found = guess(F.col(text))
    return found["lang"], found["probability"]
