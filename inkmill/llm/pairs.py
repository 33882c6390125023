"""Problem 3: prompt and response pairs with a defective response."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm import endings, language_model
from inkmill.llm.refusals import is_refusal
from inkmill.llm.wordstream import chunks

DEFECTS = ("empty", "copied", "refusal", "wrong_language", "truncated")
_WORD = re.compile(r"[^\W_]+")
_TAG = re.compile(r"<[^<>]*>")
#: Words that stand for a missing answer (fixed values).
MISSING = {
    "null", "none", "nan", "nil", "na", "n a", "undefined", "empty", "blank", "missing", "no answer", "no response", "no reply", "no output", "not available", "no content", "todo", "tbd",
    "aucune réponse", "sans réponse", "pas de réponse", "vide", "keine antwort", "ohne antwort", "leer", "sin respuesta", "ninguna respuesta", "vacío",
}
#: Names of the languages in each of them (fixed values).
_ASKED = {
    "en": r"english|englisch|anglais|inglés|ingles", "fr": r"french|französisch|français|francais|francés", "de": r"german|deutsch|allemand|alemán|aleman", "es": r"spanish|spanisch|espagnol|español|castellano",
}
_ASKED_FOR = {code: re.compile(rf"\b(?:in|into|auf|ins|en|al|to) (?:{names})\b", re.IGNORECASE) for code, names in _ASKED.items()}
#: Names of languages written in each other script, in four languages, and in their own (fixed values).
_SCRIPT_ASKED = {
    "greek": r"greek|griechisch\w*|grec|griego", "cyrillic": r"russian|ukrainian|bulgarian|serbian|russisch\w*|ukrainisch\w*|bulgarisch\w*|serbisch\w*|russe|ukrainien|bulgare|serbe|ruso|ucraniano|búlgaro|serbio|cyrillic|kyrillisch\w*",
    "armenian": r"armenian|armenisch\w*|arménien|armenio", "hebrew": r"hebrew|yiddish|hebräisch\w*|jiddisch\w*|hébreu|hebreo", "arabic": r"arabic|persian|farsi|urdu|arabisch\w*|persisch\w*|arabe|persan|árabe|persa",
    "indic": r"hindi|sanskrit|bengali|tamil|telugu|marathi|nepali|punjabi|gujarati|kannada|malayalam|sinhal\w*", "thai": r"thai|thailändisch\w*|thaï|tailandés|lao", "georgian": r"georgian|georgisch\w*|géorgien|georgiano", "ethiopic": r"amharic|amharisch\w*|amharique|amárico",
    "hangul": r"korean|koreanisch\w*|coréen|coreano", "east": r"chinese|japanese|mandarin|cantonese|chinesisch\w*|japanisch\w*|chinois|japonais|chino|japonés", "latin": r"english|french|german|spanish|italian|portuguese|latin|englisch|französisch|deutsch|spanisch|anglais|français|allemand|espagnol|inglés|francés|alemán|español",
}
_SCRIPT_NAMED = {"greek": r"ελληνικά", "cyrillic": r"русск", "hangul": r"한국어", "east": r"中文|日本語|汉语|漢語", "latin": r"английск|英語|英语|英文|영어|αγγλικά"}
_SCRIPT_ASKED_FOR = {name: re.compile(rf"\b(?:in|into|auf|ins|en|al|to) (?:{names})\b|{_SCRIPT_NAMED.get(name, '(?!)')}", re.IGNORECASE) for name, names in _SCRIPT_ASKED.items()}
#: Letters below which a text says too little of its script.
LEAST_LETTERS = 6
#: Log odds that a response must give against the prompt's language: a prior for pairs in one language, which a few
#: trigrams outweigh when they are telling, and a share for each trigram, as names and quotations speak for others.
PRIOR_ODDS, LEAST_ODDS = 12.5, 0.25


def is_empty(response: str) -> bool:
    """Only blanks, marks, markup, or a word for a missing answer."""
    words = _WORD.findall(_TAG.sub(" ", response).lower())
    return not words or (len(words) <= 3 and " ".join(words) in MISSING)


def is_copy(prompt: str, response: str) -> bool:
    """Nothing but the prompt: the words are the prompt's, in about its order, once or repeated."""
    p, r = _WORD.findall(prompt.lower()), _WORD.findall(_TAG.sub(" ", response).lower())
    if not p or len(r) < 0.6 * len(p):
        return False
    r = [w for w in r if w not in ("q", "a")]
    known, times = Counter(p), max(1, round(len(r) / len(p)))
    inside = sum((Counter(r) & Counter({w: n * times for w, n in known.items()})).values())
    if inside < 0.8 * len(r) or len(known.keys() & set(r)) < 0.6 * len(known):
        return False
    follows = set(zip(p, p[1:])) | {(p[-1], p[0])}
    return len(r) < 4 or sum(x in follows for x in zip(r, r[1:])) >= 0.5 * (len(r) - 1)


def asked_languages(prompt: str) -> set[str]:
    return {code for code, pattern in _ASKED_FOR.items() if pattern.search(prompt)}


def foreign_scripts(prompts: list[str], responses: list[str]) -> list[bool]:
    """Whether most letters of a response are of another script than most of the prompt's, and the prompt doesn't name a
    language of that script."""
    names = list(language_model.SCRIPTS)
    p, r = language_model.script_letters(prompts), language_model.script_letters(responses)
    of_p, of_r = p.argmax(axis=1), r.argmax(axis=1)
    rows = np.arange(len(prompts))
    plenty = (p.sum(axis=1) >= LEAST_LETTERS) & (r.sum(axis=1) >= LEAST_LETTERS)
    # Japanese and Korean texts hold each other's and Latin letters: both sides must be clear
    clear = (2 * r[rows, of_r] > r.sum(axis=1)) & (2 * p[rows, of_p] > p.sum(axis=1)) & (2 * r[rows, of_p] < r.sum(axis=1))
    foreign = plenty & clear & (of_p != of_r)
    return [bool(f) and not _SCRIPT_ASKED_FOR[names[of_r[i]]].search(prompts[i]) for i, f in enumerate(foreign)]


def defects(prompts: list[str], responses: list[str]) -> list[str | None]:
    """The defect of each pair, or none."""
    names = language_model.LANGUAGES
    (of_prompt, np_), (of_response, nr) = language_model.log_likelihoods(prompts), language_model.log_likelihoods(responses)
    lang_p, lang_r = of_prompt.argmax(axis=1), of_response.argmax(axis=1)
    rows = np.arange(len(prompts))
    odds = of_response[rows, lang_r] - of_response[rows, lang_p]
    ranked = np.sort(of_prompt, axis=1)
    sure = ranked[:, -1] - ranked[:, -2]
    foreign = (lang_p != lang_r) & (odds > np.maximum(PRIOR_ODDS, LEAST_ODDS * nr)) & (sure > np.maximum(1.0, 0.05 * np_))
    scripts = foreign_scripts(prompts, responses)
    out: list[str | None] = []
    for i, (prompt, response) in enumerate(zip(prompts, responses)):
        if is_empty(response):
            out.append("empty")
        elif is_copy(prompt, response):
            out.append("copied")
        elif is_refusal(response):
            out.append("refusal")
        elif scripts[i] or (foreign[i] and names[lang_r[i]] not in asked_languages(prompt)):
            out.append("wrong_language")
        elif endings.cut_score(response) > 0:
            out.append("truncated")
        else:
            out.append(None)
    return out


def defective_pairs(records: DataFrame) -> DataFrame:
    """(id, defect) of every distinct id whose pair is defective, the first of DEFECTS that holds.

    Null ids and null prompts have no pair; a null response is empty; an empty prompt is a prompt. Rows of one id are
    alike, so where they differ the smallest defect name stands. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, prompts, responses = (batch.column(i).to_pylist() for i in range(3))
            for a, b in chunks(responses):
                found = [(i, d) for i, d in zip(ids[a:b], defects(prompts[a:b], responses[a:b])) if d]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found]), pa.array([f[1] for f in found])], names=["id", "defect"])

    pairs = records.where("id is not null and prompt is not null").select("id", "prompt", F.coalesce("response", F.lit("")).alias("response"))
    return pairs.mapInArrow(run, "id string, defect string").groupBy("id").agg(F.min("defect").alias("defect"))


def defect_counts(records: DataFrame) -> DataFrame:
    """(source, defect, records) over the spellings of the source names."""
    from inkmill.llm.shared import slug

    source = records.where("id is not null").groupBy("id").agg(F.min(slug(F.col("source_dataset_name"))).alias("source"))
    return defective_pairs(records).join(source, "id").groupBy("source", "defect").agg(F.count("*").alias("records"))


def wordless(records: DataFrame) -> DataFrame:
    """(id): the empty responses that hold no letter or digit outside markup, from ``defective_pairs``."""
    bare = records.where(~F.regexp_replace(F.coalesce("response", F.lit("")), "<[^<>]*>", " ").rlike(r"[\p{L}\p{N}]")).select("id").distinct()
    return defective_pairs(records).where("defect = 'empty'").join(bare, "id", "left_semi").select("id")
