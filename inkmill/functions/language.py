"""Which language a text is in, by the frequent words that one language has and the others don't."""

from __future__ import annotations

from collections import Counter

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Frequent words, each in one list only.
WORDS = {
    "en": "the and of to that was with his for had but they this which from would have were there their been she you what when are him could who it not at into until its out our your will then than some these".split(),
    "fr": "le les et une des du dans qui pour pas sur elle est au avec ce cette ne sont plus par nous vous leur était avait ses aux".split(),
    "de": "der die und das den nicht ein zu mit sich dem ist auf im eine auch als wie wenn war ich sie er hat aber nach bei einen noch vom".split(),
    "es": "el los y las del una por para lo su al pero más muy como sin sobre este entre cuando había estaba porque desde nada todo fue era ya han".split(),
    "it": "di gli che non è sono della nel con anche questo più alla dei delle perché quando suo loro ma uno stato degli ed dal nella così essere cosa".split(),
    "pt": "não uma dos em os ao mais pela seu sua quem foi ele ela você são também isso já muito até nós há pelo tinha estava".split(),
    "nl": "het van een dat niet zijn voor ook maar aan bij naar haar geen wel nog dan hij zij deze werd kan zou door over wat wij hebben heeft worden".split(),
}
#: Hits that every language is credited with, so few words give no certainty.
PRIOR = 0.03


_OWNER = {w: code for code, ws in WORDS.items() for w in ws}
_WORD = regex.compile(r"\p{L}+")


def judge(text: str | None) -> tuple[str | None, float]:
    """(language, probability): the language with the most of its own words, the first by code of several, and its share of
    all hits. No language and 0 where there is no hit; null texts too."""
    hits = Counter(_OWNER[w] for w in _WORD.findall((text or "").lower()) if w in _OWNER)
    if not hits:
        return None, 0.0
    code = min(hits, key=lambda c: (-hits[c], c))
    return code, (hits[code] + PRIOR) / (hits.total() + PRIOR * len(WORDS))


def language_of(text: Column) -> tuple[Column, Column]:
    """Columns with the language of a text and its probability, found in Arrow batches; see ``judge``."""

    @F.pandas_udf("struct<lang:string,probability:double>")
    def judged(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([judge(t) for t in texts], columns=["lang", "probability"])

    found = judged(text)
    return found["lang"], found["probability"]


def detect(df: DataFrame, text: str = "response") -> tuple[Column, Column]:
    """(language, probability) of the records of a table, as the filter stage asks for them."""
    return language_of(F.col(text))
