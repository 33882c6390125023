"""Record filters, in the order in which they are cheapest: length, language, patterns, duplicates."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.functions.text import token_count
from inkmill.sources.index import checkpointed, first_of


@dataclass(frozen=True)
class FilterSettings:
    min_tokens: int = 10
    max_tokens: int = 4000
    lang_threshold: float = 0.9
    blacklist: Sequence[str] = ()
    counter: Callable[[Column], Column] = token_count


def token_range(low: int, high: int, text: Column | str = "response", counter: Callable[[Column], Column] = token_count) -> Column:
    """Texts of ``low`` to ``high`` tokens, both included; empty and null texts never pass."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce((F.length(c) > 0) & counter(c).between(low, high), F.lit(False))


def in_language(lang: Column, probability: Column, threshold: float, wanted: str = "en") -> Column:
    """The detector's first choice is the wanted language and sure enough; a threshold of 0 or less passes all."""
    if threshold <= 0:
        return F.lit(True)
    return F.coalesce((lang == wanted) & (probability >= threshold), F.lit(False))


def not_blacklisted(text: Column, patterns: Sequence[str]) -> Column:
    """No pattern occurs anywhere in the text, upper and lower case alike. A pattern that doesn't compile raises here."""
    ok = F.lit(True)
    for p in patterns:
        re.compile(p)
        ok = ok & ~F.coalesce(text.rlike(f"(?iu){p}"), F.lit(False))
    return ok


def text_hash(text: Column) -> Column:
    return F.sha1(text)


def deduplicate(df: DataFrame, order: Sequence[str], text: str = "response") -> DataFrame:
    """The first row in ``order`` of each distinct text, over all datasets. Null texts count as one."""
    return first_of(df, text_hash(F.col(text)), tuple(order))


def seen_hashes(df: DataFrame, text: str = "response") -> DataFrame:
    """The hash table that a later run is held against."""
    return df.select(text_hash(F.col(text)).alias("text_hash")).distinct()


def deduplicate_against(df: DataFrame, seen: DataFrame, order: Sequence[str], text: str = "response") -> DataFrame:
    """New distinct texts only: none whose hash is in ``seen`` (column text_hash)."""
    fresh = df.withColumn("_t", text_hash(F.col(text))).join(seen.select(F.col("text_hash").alias("_t")), "_t", "left_anti").drop("_t")
    return deduplicate(fresh, order, text)


def filter_chain(df: DataFrame, settings: FilterSettings, order: Sequence[str], *, lang: Column | None = None, probability: Column | None = None, seen: DataFrame | None = None) -> DataFrame:
    """All filters; only rows that pass the others take part in the search for duplicates.

    Without a detector (``lang`` null) the language filter is off. The language that passed is noted in meta.lang. Texts
    whose hash is in ``seen`` (column text_hash) came in an earlier run and go.
    """
    kept = df.where(token_range(settings.min_tokens, settings.max_tokens, counter=settings.counter))
    if lang is not None and settings.lang_threshold > 0:
        kept = kept.where(in_language(lang, F.lit(1.0) if probability is None else probability, settings.lang_threshold))
        if "meta" in df.columns:
            kept = kept.withColumn("meta", F.col("meta").withField("lang", F.lit("en")))
    kept = kept.where(not_blacklisted(F.col("response"), settings.blacklist))
    if lang is not None:
        # a detector costs more than writing what passes, and the search for duplicates reads its input twice
        kept = checkpointed(kept)
    return deduplicate(kept, order) if seen is None else deduplicate_against(kept, seen, order)


def filter_counts(df: DataFrame, settings: FilterSettings, *, lang: Column | None = None, probability: Column | None = None, by: str = "source_dataset_name") -> DataFrame:
    """(by, processed, in_range, in_language, clean, retained) in one pass: what each filter leaves, cumulated; retained
    counts distinct texts within the group."""
    a = token_range(settings.min_tokens, settings.max_tokens, counter=settings.counter)
    b = a & (in_language(lang, F.lit(1.0) if probability is None else probability, settings.lang_threshold) if lang is not None else F.lit(True))
    c = b & not_blacklisted(F.col("response"), settings.blacklist)
    marked = df.select(F.col(by), a.alias("a"), b.alias("b"), c.alias("c"), text_hash(F.col("response")).alias("h"))
    return marked.groupBy(by).agg(
        F.count("*").alias("processed"), F.count_if("a").alias("in_range"), F.count_if("b").alias("in_language"), F.count_if("c").alias("clean"), F.count_distinct(F.when(F.col("c"), F.col("h"))).alias("retained")
    )
