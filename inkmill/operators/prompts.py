"""Prompts of records: which need one, and what becomes of a model's suggestion."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.functions.text import token_count, truncate_prompt


def needs_prompt(most_tokens: int = 1024, counter: Callable[[Column], Column] = token_count) -> Column:
    """No prompt yet (null or empty) and a response short enough to guess one from."""
    return (F.coalesce(F.length("prompt"), F.lit(0)) == 0) & (F.coalesce(F.length("response"), F.lit(0)) > 0) & (counter(F.col("response")) <= most_tokens)


def tag_prompts(df: DataFrame, suggestion: Column, *, most_tokens: int = 1024, most_chars: int = 256, retag_existing: bool = False, counter: Callable[[Column], Column] = token_count) -> DataFrame:
    """Fill in missing prompts from ``suggestion``, cut to size, and mark them as reconstructed.

    Existing prompts keep their type, unless ``retag_existing``. An empty or null suggestion leaves the record as it is.
    """
    new = F.when(needs_prompt(most_tokens, counter) & (F.length(suggestion) > 0), truncate_prompt(suggestion, most_chars))
    tagged = new.isNotNull() | (F.lit(retag_existing) & (F.coalesce(F.length("prompt"), F.lit(0)) > 0))
    meta = F.col("meta").withField("prompt_type", F.when(tagged, F.lit("reconstructed")).otherwise(F.col("meta.prompt_type")))
    return df.withColumns({"prompt": F.coalesce(F.when(F.length("prompt") > 0, F.col("prompt")), new, F.col("prompt")), "meta": meta})
