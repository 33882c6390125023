"""Where a model's answers come from."""

from __future__ import annotations

import json
import os
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.plans.config import ModelSettings


class Backend(Protocol):
    def answer(self, df: DataFrame, stage: str, settings: ModelSettings, *, temperature: float, max_tokens: int) -> DataFrame:
        """(id, content) for rows (id, request); content is null where the model gave none."""


class StubBackend:
    """Answers by rule from the id, as native columns: the same in every run and in every engine."""

    def __init__(self, genres: Sequence[str], metrics: Sequence[str]) -> None:
        self.genres, self.metrics = tuple(genres), tuple(metrics)

    def _byte(self, salt: str) -> Column:
        return F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(salt), "id"), 256), 1, 2), 16, 10).cast("int")

    def answer(self, df: DataFrame, stage: str, settings: ModelSettings, *, temperature: float, max_tokens: int) -> DataFrame:
        if stage == "classification":
            content = F.element_at(F.array(*map(F.lit, self.genres)), self._byte("genre") % len(self.genres) + 1)
        elif stage == "scoring":
            pairs = [F.concat(F.lit(f'"{m}": '), F.round(self._byte(m) / 255, 3).cast("string")) for m in self.metrics]
            content = F.concat(F.lit("{"), F.concat_ws(", ", *pairs), F.lit("}"))
        else:
            content = F.concat(F.lit("Write piece "), F.substring(F.sha2("id", 256), 1, 8))
        return df.select("id", content.alias("content"))


def content_of(reply: object, chat: bool) -> str | None:
    """The stripped answer of the first choice; null where there is none, or none that is text."""
    choices = reply.get("choices") if isinstance(reply, dict) else None
    first = choices[0] if isinstance(choices, list) and choices and isinstance(choices[0], dict) else {}
    held = first.get("message") if chat else first
    found = held.get("content" if chat else "text") if isinstance(held, dict) else None
    return found.strip() if isinstance(found, str) else None


def call(
    settings: ModelSettings, request: str, *, temperature: float, max_tokens: int, stop: Sequence[str] = (), sleep: Callable[[float], None] = time.sleep
) -> str | None:
    """One request to a chat or completion service; retried with growing pauses.

    Null when all tries fail or the reply has no text; an empty answer is one.
    """
    key = settings.api_key or ""
    if key.startswith("ENV:"):
        key = os.environ.get(key[4:], "")
    chat = settings.endpoint != "completions"
    sent: dict[str, object] = {"model": settings.model_name, "temperature": temperature, "max_tokens": max_tokens}
    if chat:
        messages = [{"role": "user", "content": request}]
        if "qwen3" in (settings.model_name or "").lower():
            messages.insert(0, {"role": "system", "content": "/no_think"})
        sent["messages"] = messages
    else:
        sent["prompt"] = request
    if stop:
        sent["stop"] = list(stop)
    headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {key}"} if key else {})
    url = f"{(settings.api_base_url or '').rstrip('/')}/{'chat/completions' if chat else 'completions'}"
    tries = 1 + (3 if settings.max_retries is None else settings.max_retries)
    for n in range(tries):
        try:
            with urllib.request.urlopen(urllib.request.Request(url, json.dumps(sent).encode(), headers), timeout=settings.timeout_seconds or 60) as reply:
                return content_of(json.loads(reply.read()), chat)
        except (urllib.error.URLError, OSError, ValueError):
            if n + 1 < tries:
                sleep(2.0**n)
    return None


class HttpBackend:
    """Requests to a chat service, one session of bounded threads a partition.

    Partitions times threads stay within the stage's limit of requests at a time. Materialise what it returns: a plan
    that runs twice asks twice.
    """

    def __init__(self, threads: int = 8) -> None:
        self.threads = threads

    def answer(self, df: DataFrame, stage: str, settings: ModelSettings, *, temperature: float, max_tokens: int) -> DataFrame:
        most = settings.max_concurrent_requests or 4
        threads = max(1, min(self.threads, most))

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            with ThreadPoolExecutor(threads) as pool:
                for f in frames:
                    yield pd.DataFrame({"id": f["id"], "content": list(pool.map(lambda r: call(settings, r, temperature=temperature, max_tokens=max_tokens, stop=settings.stop or ()), f["request"]))})

        return df.select("id", "request").repartition(max(1, most // threads)).mapInPandas(run, "id string, content string")
