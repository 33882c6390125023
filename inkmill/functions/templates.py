"""Prompts sent to a model. Text around the response is constant, so rendering is a concatenation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The wording of the three prompts.
GENRE_HEAD = "You are a text classification expert. Your task is to classify the following text into one primary genre category.\n\nAvailable primary genre categories:\n"
GENRE_TAIL = (
    "\n\nBased on the text, choose the single most fitting primary genre category from the list above.\n"
    'If the text is too short, ambiguous, or doesn\'t clearly fit any category, choose "unknown".\n\nPrimary Genre Category:'
)
PROMPT_HEAD = (
    "Given the following assistant's answer, write *one* plausible and concise user prompt that could have realistically produced this answer. "
    "The prompt should sound like it was written by a human.\n\nAssistant's Answer:\n"
)
PROMPT_TAIL = "\n\nUser Prompt:"
SCORE_HEAD = (
    "You are an expert literary critic.  \nEvaluate the text against each metric and **return a single JSON object** whose\n"
    "property names are the *metric names* shown below and whose values are the\nnumeric scores (0.0 – 1.0).  \nNo prose, no markdown – just the JSON.\n\nTEXT:\n"
)
SCORE_MIDDLE = "\n\nYour task is to score the above text on the following criteria on a 0-1 scale:\n"
SCORE_NOTE = "\n\n---  \n\nNote: if a criterion doesn't apply to the text, omit it from the output.\n\nReturn **only** a JSON object like:\n\n{\n"


def _quoted(c: Column) -> Column:
    return F.concat(F.lit('"""\n'), F.coalesce(c, F.lit("")), F.lit('\n"""'))


def genre_prompt(response: Column, genres: Sequence[str]) -> Column:
    listed = "".join(f"\n- {g}\n" for g in genres) + "\n- unknown"
    return F.concat(F.lit(f"{GENRE_HEAD}{listed}\n\nTEXT:\n"), _quoted(response), F.lit(GENRE_TAIL))


def reconstruction_prompt(response: Column) -> Column:
    return F.concat(F.lit(PROMPT_HEAD), _quoted(response), F.lit(PROMPT_TAIL))


def scoring_tail(metrics: Sequence[tuple[str, str, str]]) -> str:
    """What follows the text: a line for each (name, description, hint), and the shape of the answer."""
    lines = "".join(f"\n{name} — {text} (Hint: {hint})\n" for name, text, hint in metrics)
    shape = ",\n".join(f'\n  "{name}": <float between 0.0 and 1.0>' for name, _, _ in metrics) + ("\n" if metrics else "")
    return f"{SCORE_MIDDLE}{lines}{SCORE_NOTE}{shape}\n}}"


def scoring_prompt(response: Column, rubric: Column, rubrics: dict[str, Sequence[tuple[str, str, str]]], default: str = "default") -> Column:
    """The prompt for the rubric named in ``rubric``; a name without a rubric is scored by the default's metrics."""
    tails = F.create_map(*[F.lit(x) for name, metrics in rubrics.items() for x in (name, scoring_tail(metrics))])
    return F.concat(F.lit(SCORE_HEAD), _quoted(response), F.coalesce(F.try_element_at(tails, rubric), F.try_element_at(tails, F.lit(default))))
