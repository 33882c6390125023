"""Configuration of a run, from YAML."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields, replace
from pathlib import Path
from typing import Any, get_args, get_type_hints

import yaml

from inkmill.operators.filters import FilterSettings
from inkmill.operators.labels import DEFAULT_GENRES
from inkmill.operators.scoring import DEFAULT_RUBRIC
from inkmill.sources.readers import FORMATS, parse_limit

STAGES_WITH_MODEL = ("classification", "prompt_reconstruction", "scoring")


@dataclass(frozen=True)
class ModelSettings:
    api_base_url: str | None = None
    api_key: str | None = None
    model_name: str | None = None
    timeout_seconds: int | None = None
    max_retries: int | None = None
    max_concurrent_requests: int | None = None
    endpoint: str | None = None  # chat (also where unset) or completions
    stop: tuple[str, ...] | None = None

    def __post_init__(self) -> None:
        if self.endpoint not in (None, "chat", "completions"):
            raise ValueError(f"unknown endpoint {self.endpoint!r}")

    def over(self, base: ModelSettings) -> ModelSettings:
        """These settings, with the base's where they are not set. 0 is a setting."""
        return replace(base, **{f.name: v for f in fields(self) if (v := getattr(self, f.name)) is not None})


@dataclass(frozen=True)
class Dataset:
    name: str
    path: str
    format: str
    type: str
    columns: Mapping[str, str] = field(default_factory=dict)
    max_items: int | str | None = None
    config: str | None = None
    split: str | None = None

    def __post_init__(self) -> None:
        if self.format not in FORMATS or self.type not in "ABC" or len(self.type) != 1:
            raise ValueError(f"dataset {self.name}: format must be one of {FORMATS} and type A, B or C")
        parse_limit(self.max_items)


@dataclass(frozen=True)
class Metric:
    name: str
    description: str = ""
    prompt_hint: str = ""


@dataclass(frozen=True)
class Settings:
    """All of a run. Rubrics and routing are checked on loading: a route to a rubric that doesn't exist raises."""

    datasets: tuple[Dataset, ...] = ()
    rubrics: Mapping[str, tuple[Metric, ...]] = field(default_factory=dict)
    rubric_mapping: Mapping[str, str] = field(default_factory=dict)
    model: ModelSettings = ModelSettings()
    stage_models: Mapping[str, ModelSettings] = field(default_factory=dict)
    stage_model_names: Mapping[str, str] = field(default_factory=dict)
    filter: FilterSettings = FilterSettings()
    dedup_store: str | None = None  # table of the hashes of earlier runs
    max_chunk_tokens: int = 3800
    sentence_overlap: int = 1
    segment_shape_c: bool = False
    tokenizer: str | None = None  # a rank file; the approximate counter where unset
    prompt_most_tokens: int = 1024
    prompt_most_chars: int = 256
    genres: tuple[str, ...] = DEFAULT_GENRES
    quotas: Mapping[str, int] = field(default_factory=dict)
    default_quota: int = 5000
    calibrate: bool = True
    lower_percentile: float = 5
    upper_percentile: float = 95
    min_metrics_present: float = 0.7
    splits: Mapping[str, float] = field(default_factory=lambda: {"train": 0.90, "validation": 0.05, "test": 0.05})
    name_prefix: str = "final"
    artifact_format: str = "parquet"
    seed: str = "0"

    def __post_init__(self) -> None:
        if wrong := sorted(set(self.rubric_mapping.values()) - set(self.rubrics)) if self.rubrics else []:
            raise ValueError(f"rubric_mapping names rubrics that do not exist: {wrong}")
        names = [d.name for d in self.datasets]
        if len(names) != len(set(names)):
            raise ValueError("dataset names must differ")

    def metrics(self) -> dict[str, tuple[str, ...]]:
        return {name: tuple(m.name for m in ms) for name, ms in self.rubrics.items()}

    def model_for(self, stage: str) -> ModelSettings:
        """The stage's settings over the default's. A stage's own model name counts only where neither sets one."""
        merged = self.stage_models.get(stage, ModelSettings()).over(self.model)
        return merged if merged.model_name else replace(merged, model_name=self.stage_model_names.get(stage))


def _model(raw: Mapping[str, Any] | None) -> ModelSettings:
    held = dict(raw or {})
    if held.get("stop") is not None:
        held["stop"] = (held["stop"],) if isinstance(held["stop"], str) else tuple(held["stop"])
    return _fill(ModelSettings, held)


def _fill(kind: type, raw: Mapping[str, Any]) -> Any:
    known = {f.name for f in fields(kind)}
    if unknown := sorted(set(raw) - known):
        raise ValueError(f"{kind.__name__}: unknown keys {unknown}")
    hints = get_type_hints(kind)
    for k, v in raw.items():
        plain = [t for t in (*get_args(hints[k]), hints[k]) if t in (int, str, float)]
        if v is not None and plain and not isinstance(v, (*plain, int) if float in plain else tuple(plain)):
            raise ValueError(f"{kind.__name__}.{k}: {v!r} is of the wrong type")
    return kind(**raw)


def load_rubrics(folder: str | Path) -> dict[str, tuple[Metric, ...]]:
    """Rubrics of a folder's YAML files in the order of their names; a name that comes twice raises."""
    out: dict[str, tuple[Metric, ...]] = {}
    for path in sorted(Path(folder).glob("*.yaml")):
        raw = yaml.safe_load(path.read_text(encoding="utf-8"))
        if raw["name"] in out:
            raise ValueError(f"rubric {raw['name']} is defined twice")
        out[raw["name"]] = tuple(_fill(Metric, m) for m in raw["metrics"])
    if out and DEFAULT_RUBRIC not in out:
        raise ValueError(f"there is no rubric {DEFAULT_RUBRIC!r}")
    return out


def load_settings(run: str | Path, datasets: str | Path, rubrics: str | Path) -> Settings:
    """Settings from a run file, a dataset list and a folder of rubrics."""
    raw = yaml.safe_load(Path(run).read_text(encoding="utf-8")) or {}
    pre, post = raw.get("preprocessing", {}), raw.get("postprocessing", {})
    flt, seg, rec = pre.get("filter", {}), pre.get("segmentation", {}), pre.get("prompt_reconstruction", {})
    cls, norm, score, cal = raw.get("classification", {}), raw.get("normalization", {}), raw.get("scoring", {}), post.get("calibration", {})
    listed = yaml.safe_load(Path(datasets).read_text(encoding="utf-8")) or {}
    stages = {"classification": cls, "prompt_reconstruction": rec, "scoring": score}
    quotas = norm.get("quotas", {})
    return Settings(
        datasets=tuple(Dataset(d["name"], d["path"], d["format"], d["type"], d.get("columns") or {}, d.get("max_items"), d.get("hf_dataset_config"), d.get("split")) for d in listed.get("datasets", [])),
        rubrics=load_rubrics(rubrics),
        rubric_mapping=raw.get("rubric_mapping", {}),
        model=_model(raw.get("default_llm_settings")),
        stage_models={k: _model(v.get("llm_settings")) for k, v in stages.items()},
        stage_model_names={k: v["model_name"] for k, v in stages.items() if v.get("model_name")},
        filter=FilterSettings(flt.get("min_response_tokens", 10), flt.get("max_response_tokens", 4000), flt.get("lang_id_threshold", 0.9), tuple(flt.get("blacklist_regex_patterns") or ())),
        dedup_store=flt.get("dedup_store"),
        max_chunk_tokens=seg.get("max_chunk_tokens", 3800),
        sentence_overlap=seg.get("sentence_overlap_count", 1),
        segment_shape_c=seg.get("segment_shape_c", False),
        tokenizer=raw.get("tokenizer"),
        prompt_most_tokens=rec.get("max_response_tokens_for_reconstruction", 1024),
        prompt_most_chars=rec.get("reconstructed_prompt_max_chars", 256),
        genres=tuple(cls.get("top_level_genres_for_prompt") or DEFAULT_GENRES),
        quotas=quotas.get("class.top", quotas) if quotas else {},
        default_quota=norm.get("default_quota_per_class", 5000),
        calibrate=cal.get("enabled", True),
        lower_percentile=cal.get("lower_percentile", 5),
        upper_percentile=cal.get("upper_percentile", 95),
        min_metrics_present=post.get("min_metrics_present_percent", 0.7),
        splits=post.get("splits") or {"train": 0.90, "validation": 0.05, "test": 0.05},
        name_prefix=post.get("final_dataset_name_prefix", "final"),
        artifact_format=raw.get("artifact_format", "parquet"),
        seed=str(raw.get("seed", "0")),
    )
