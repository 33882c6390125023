"""Resuming: the results already there are the ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pending(df: DataFrame, done: DataFrame | None, key: str = "id") -> DataFrame:
    """Rows whose id has no result yet; all rows if there are no results, and rows with a null id."""
    return df if done is None else df.join(done.select(key), key, "left_anti").select(*df.columns)


def pending_labels(df: DataFrame, done: DataFrame) -> DataFrame:
    """Rows without a result or without a label."""
    marked = df.join(done.select("id", F.lit(True).alias("_d")).distinct(), "id", "left")
    return marked.where(F.col("_d").isNull() | F.col("classification.top").isNull()).select(*df.columns)


def pending_scores(df: DataFrame, done: DataFrame, force: bool = False) -> DataFrame:
    """Rows without a result and without scores; all rows if forced."""
    return df if force else pending(df, done).where(F.coalesce(F.size("scores"), F.lit(0)) <= 0)


def merge_results(df: DataFrame, results: DataFrame, columns: Sequence[str], key: str = "id") -> DataFrame:
    """Put results in place by id; where a row has none, or a null one, what it had stays.

    Of several results of an id the one of the smallest hash counts, whatever the order of the rows.
    """
    hashed = F.xxhash64(*[F.to_json(F.struct(c)) for c in columns])
    picked = results.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(F.struct(*columns), hashed).alias("_new"))
    new = picked.select(key, *[F.col(f"_new.{c}").alias(f"_new_{c}") for c in columns])
    joined = df.join(new, key, "left")
    return joined.select(*[F.coalesce(f"_new_{c}", c).alias(c) if c in columns else F.col(c) for c in df.columns])
