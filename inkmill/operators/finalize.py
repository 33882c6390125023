"""Splits by hash."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.functions.ids import unit_hash

RATIOS = {"train": 0.90, "validation": 0.05, "test": 0.05}


def boundaries(ratios: Mapping[str, float]) -> list[tuple[str, float]]:
    """(split, upper bound) in the order of the names; ratios that do not sum to 1 are divided by their sum."""
    total = sum(ratios.values())
    if total <= 0 or min(ratios.values()) < 0:
        raise ValueError("split ratios must be positive")
    shares = {k: v if abs(total - 1) < 1e-9 else v / total for k, v in ratios.items()}
    out, upto = [], 0.0
    for name in sorted(shares):
        upto += shares[name]
        out.append((name, upto))
    return out


def split_of(key: Column, ratios: Mapping[str, float] = RATIOS) -> Column:
    """The split of an id, the same in every run; what rounding leaves over goes to the first split."""
    u, bounds = unit_hash(key), boundaries(ratios)
    out = F.lit(None).cast("string")
    for name, bound in reversed(bounds):
        out = F.when(u < bound, name).otherwise(out)
    return F.coalesce(out, F.lit(bounds[0][0]))


def assign_splits(df: DataFrame, ratios: Mapping[str, float] = RATIOS) -> DataFrame:
    return df.withColumn("split", split_of(F.col("id"), ratios))


def split_report(df: DataFrame) -> DataFrame:
    """(split, records, percent) of rows that have a split."""
    sizes = df.groupBy("split").agg(F.count("*").alias("records"))
    # one row a split by now, so the window over all of them is small
    return sizes.select("split", "records", (F.col("records") * 100 / F.expr("sum(records) over ()")).alias("percent"))
