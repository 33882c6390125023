"""Rubrics: routing of records, and scores from a judge's reply."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from inkmill.functions.text import strip

# The metrics of each rubric.
_STORY = (
    "character_authenticity", "original_premise", "prose_precision", "emotional_resonance", "structural_coherence", "distinctive_voice", "thematic_depth", "sensory_atmosphere", "natural_dialogue", "earned_endings",
)
RUBRICS: dict[str, tuple[str, ...]] = {
    "default": _STORY,
    "narrative_creative": _STORY,
    "academic_informative": ("argumentative_rigor", "source_credibility", "conceptual_clarity", "original_analysis", "methodological_soundness", "contextual_awareness", "evidence_quality", "accessible_complexity", "structural_signposting", "practical_significance"),
    "professional": ("audience_appropriate", "actionable_specificity", "persuasive_logic", "efficiency_concision", "strategic_structure", "credibility_indicators", "visual_formatting", "risk_awareness", "measurable_outcomes", "call_to_action"),
    "entertainment_personal": ("authentic_voice", "engaging_momentum", "relatable_connection", "natural_humor", "vulnerable_boundaries", "fresh_perspective", "conversational_clarity", "multimedia_integration", "community_engagement", "memorable_takeaway"),
    "adult": ("consensual_dynamics", "psychological_realism", "sensual_specificity", "emotional_complexity", "creative_scenarios", "tension_building", "character_driven", "avoids_stereotypes", "narrative_integration", "linguistic_variety"),
}
DEFAULT_RUBRIC = "default"
ENVELOPE = "struct<choices:array<struct<message:struct<content:string>>>>"


def namespaced(rubrics: Mapping[str, Sequence[str]] = RUBRICS) -> list[str]:
    """All score keys, ``rubric.metric``."""
    return [f"{name}.{m}" for name, metrics in rubrics.items() for m in metrics]


def glob_pattern(glob: str) -> str:
    """A shell pattern (* ? [ab] [!ab]) as a regular expression for a whole value."""
    out, i = "", 0
    while i < len(glob):
        c = glob[i]
        if c == "[" and (end := glob.find("]", i + 2)) > 0:
            inner = glob[i + 1 : end].replace("\\", r"\\")
            out += f"[^{inner[1:]}]" if inner.startswith("!") else f"[{inner}]"
            i = end
        else:
            out += {"*": ".*", "?": "."}.get(c, re.escape(c))
        i += 1
    return rf"(?s)\A{out}\z"


def route(label: Column, rules: Mapping[str, str] | Sequence[tuple[str, str]], rubrics: Mapping[str, Sequence[str]] = RUBRICS) -> Column:
    """The rubric of the first rule whose pattern fits the label; ``default`` where none does.

    A null label is routed as ``unknown``. A rule that names no rubric raises here.
    """
    rules = list(rules.items()) if isinstance(rules, Mapping) else list(rules)
    if wrong := [r for _, r in rules if r not in rubrics]:
        raise ValueError(f"rules name rubrics that do not exist: {wrong}")
    top, out = F.coalesce(label, F.lit("unknown")), []
    for glob, rubric in rules:
        if glob == "*":
            out.append(F.lit(rubric))
            break
        out.append(F.when(top.rlike(glob_pattern(glob)) if set(glob) & set("*?[") else top == glob, rubric))
    return F.coalesce(*out, F.lit(DEFAULT_RUBRIC))


def completion(envelope: Column) -> Column:
    """The stripped content of the first choice of a chat reply; null where the envelope has none or is broken."""
    content = F.try_element_at(F.from_json(envelope, ENVELOPE)["choices"], F.lit(1))["message"]["content"]
    return strip(content)


_FENCE = re.compile(r"```(?:json)?\s*(.*?)```", re.DOTALL | re.IGNORECASE)


def read_scores(reply: str | None, metrics: Sequence[str]) -> dict[str, float | None]:
    """Scores in [0, 1] of the metrics in a reply; null where a metric is missing or no number.

    What counts is the first code fence if there is one, from the first { to the last }, read as strict JSON. Truth
    values count as 1 and 0, NaN as 1; of a repeated key the last counts.
    """
    nothing: dict[str, float | None] = dict.fromkeys(metrics)
    text = (reply or "").strip()
    if fenced := _FENCE.search(text):
        text = fenced.group(1)
    a, b = text.find("{"), text.rfind("}")
    if a < 0 or b < a:
        return nothing
    try:
        found = json.loads(text[a : b + 1])
    except (ValueError, RecursionError):
        return nothing
    if not isinstance(found, dict):
        return nothing
    out = dict(nothing)
    for m in metrics:
        v = found.get(m)
        if isinstance(v, (bool, int, float)):
            out[m] = 1.0 if isinstance(v, float) and math.isnan(v) else float(min(1, max(0, v)))
    return out


def parse_scores(reply: Column, rubric: Column, rubrics: Mapping[str, Sequence[str]] = RUBRICS) -> Column:
    """map<string, double> with a key ``rubric.metric`` for each metric of the row's rubric; see ``read_scores``.

    A rubric that does not exist takes the default's metrics and name. Strict JSON needs Python, in Arrow batches.
    """
    held = {k: tuple(v) for k, v in rubrics.items()}

    @F.pandas_udf("map<string,double>")
    def parse(replies: pd.Series, names: pd.Series) -> pd.Series:
        out = []
        for text, name in zip(replies, names):
            name = name if name in held else DEFAULT_RUBRIC
            out.append({f"{name}.{m}": v for m, v in read_scores(text, held[name]).items()})
        return pd.Series(out)

    return parse(reply, rubric)


_VALUE = r"(?:-?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?|\"[^\"\\]*\"|true|false|null)"
#: One flat JSON object of plain names and values.
FLAT = rf"\s*\{{\s*(?:\"[^\"\\]*\"\s*:\s*{_VALUE}\s*(?:,\s*\"[^\"\\]*\"\s*:\s*{_VALUE}\s*)*)?\}}\s*"


def parse_scores_native(reply: Column, metrics: Sequence[str]) -> Column:
    """The same for replies that are one flat JSON object, without Python: map<metric, double> of the metrics found that
    are numbers. Null for every other reply, so the exact parser can take what is left."""
    flat = F.from_json(F.when(reply.rlike(rf"\A{FLAT}\z"), reply), "map<string,string>")
    found = F.map_filter(flat, lambda k, v: k.isin(*metrics) & v.rlike(r"^-?[0-9]+(\.[0-9]+)?([eE][-+]?[0-9]+)?$"))
    return F.transform_values(found, lambda k, v: F.least(F.lit(1.0), F.greatest(F.lit(0.0), v.cast("double"))))
