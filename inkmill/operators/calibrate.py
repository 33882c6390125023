"""Calibration, completeness and coverage of scores."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.operators.scoring import DEFAULT_RUBRIC, RUBRICS, namespaced
from inkmill.sources.index import checkpointed

SUFFIX = "_calibrated"


#: Buckets into which the values of a metric are counted in one pass.
BUCKETS = 4096


def metric_percentiles(df: DataFrame, low: float = 5, high: float = 95, metrics: Sequence[str] | None = None) -> DataFrame:
    """(metric, n, lo, hi, least, most) of every metric with at least two values; percentiles by linear interpolation.

    Exact, with bounded state: a pass counts the values of each metric in BUCKETS between the bounds within which a wanted
    rank lies, with the least and greatest of each bucket; the bucket of the rank gives the next bounds, until all its
    values are equal. Every pass narrows the bounds by BUCKETS, so numbers of any kind take a few, usual scores one.
    """
    keys = metrics if metrics is not None else namespaced()
    rows = df.select(F.explode("scores").alias("metric", "score")).where(F.col("score").isNotNull() & ~F.isnan("score") & F.col("metric").isin(*keys))
    rows = checkpointed(rows)  # metric and score alone, read by each pass
    ends = [r for r in rows.groupBy("metric").agg(F.count("*").alias("n"), F.min("score").alias("least"), F.max("score").alias("most")).collect() if r["n"] >= 2]
    found: dict[tuple[str, int], float] = {}
    open_: dict[tuple[str, int], tuple[float, float, int]] = {}
    ranks = {}
    for r in ends:
        at = [(r["n"] - 1) * p / 100 for p in (low, high)]
        ranks[r["metric"]] = at
        for rank in {k for x in at for k in (math.floor(x), math.ceil(x))}:
            open_[r["metric"], rank] = (r["least"], r["most"], 0)
    while open_:
        for key, (a, b, _) in list(open_.items()):
            if a == b:
                found[key] = a
                del open_[key]
        if not open_:
            break
        spans = sorted({(m, a, b) for (m, _), (a, b, _) in open_.items()})
        by_metric = F.create_map(*[x for m in sorted({m for m, _, _ in spans}) for x in (F.lit(m), F.array(*[F.struct(F.lit(i).alias("i"), F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(0.5 if math.isinf(b - a) else 1.0).alias("k")) for i, (k, a, b) in enumerate(spans) if k == m]))])
        inside = rows.select("score", F.explode(F.try_element_at(by_metric, F.col("metric"))).alias("s")).where(F.col("score").between(F.col("s.a"), F.col("s.b")))
        # halves where the difference of the bounds would not be finite
        k = F.col("s.k")
        place = F.least(F.lit(BUCKETS - 1), F.floor((F.col("score") * k - F.col("s.a") * k) / (F.col("s.b") * k - F.col("s.a") * k) * BUCKETS)).cast("int")
        counted: dict[int, list] = {}
        for r in inside.groupBy(F.col("s.i").alias("i"), place.alias("bucket")).agg(F.count("*").alias("n"), F.min("score").alias("a"), F.max("score").alias("b")).orderBy("i", "bucket").collect():
            counted.setdefault(r["i"], []).append(r)
        for (metric, rank), (a, b, below) in list(open_.items()):
            for r in counted[spans.index((metric, a, b))]:
                if rank < below + r["n"]:
                    open_[metric, rank] = (r["a"], r["b"], below)
                    break
                below += r["n"]
    out = []
    for r in ends:
        lo, hi = (found[r["metric"], math.floor(x)] + (x - math.floor(x)) * (found[r["metric"], math.ceil(x)] - found[r["metric"], math.floor(x)]) for x in ranks[r["metric"]])
        out.append((r["metric"], r["n"], lo, hi, r["least"], r["most"]))
    return df.sparkSession.createDataFrame(out, "metric string, n bigint, lo double, hi double, least double, most double")


def scaled(score: Column, lo: Column, hi: Column) -> Column:
    """A score between its percentiles as a number in [0, 1]; 0.5 where they are equal."""
    return F.when(hi == lo, F.lit(0.5)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), (score - lo) / (hi - lo))))


def calibrate(df: DataFrame, low: float = 5, high: float = 95, metrics: Sequence[str] | None = None, enabled: bool = True) -> DataFrame:
    """Add to each record's scores the key ``metric_calibrated`` of every metric that it has and that has percentiles.

    The percentiles are collected first, at most one row for each metric that the configuration names, and enter the
    plan as a constant.
    """
    if not enabled:
        return df
    found = metric_percentiles(df, low, high, metrics).collect()
    if not found:
        return df
    bounds = F.create_map(*[c for r in found for c in (F.lit(r["metric"]), F.struct(F.lit(r["lo"]).alias("lo"), F.lit(r["hi"]).alias("hi")))])
    held = F.map_filter("scores", lambda k, v: v.isNotNull() & k.isin(*[r["metric"] for r in found]))
    new = F.transform_values(held, lambda k, v: scaled(v, F.try_element_at(bounds, k)["lo"], F.try_element_at(bounds, k)["hi"]))
    named = F.transform_keys(new, lambda k, v: F.concat(k, F.lit(SUFFIX)))
    kept = F.map_filter("scores", lambda k, v: ~k.endswith(SUFFIX))
    return df.withColumn("scores", F.map_concat(kept, named))


def scored_rubric(rubrics: Mapping[str, Sequence[str]] = RUBRICS) -> Column:
    """The rubric under which a record was scored: the one that most of its scores belong to, the first by name of
    several; null where no score belongs to any."""
    held = F.map_keys(F.map_filter("scores", lambda k, v: v.isNotNull() & ~k.endswith(SUFFIX)))
    named = F.array(*[F.struct((-F.size(F.array_intersect(held, F.array(*[F.lit(f"{name}.{m}") for m in ms])))).alias("n"), F.lit(name).alias("name")) for name, ms in rubrics.items()])
    first = F.array_min(named)
    return F.when(first["n"] < 0, first["name"])


def present_share(rubric: Column, rubrics: Mapping[str, Sequence[str]] = RUBRICS) -> Column:
    """Share of the metrics of a record's own rubric that have a score."""
    names = F.create_map(*[F.lit(x) if isinstance(x, str) else F.array(*map(F.lit, x)) for name, m in rubrics.items() for x in (name, [f"{name}.{k}" for k in m])])
    own = F.coalesce(F.try_element_at(names, rubric), F.try_element_at(names, F.lit(DEFAULT_RUBRIC)))
    return F.size(F.filter(own, lambda n: F.try_element_at("scores", n).isNotNull())) / F.size(own)


def drop_incomplete(df: DataFrame, rubric: Column, threshold: float = 0.7, rubrics: Mapping[str, Sequence[str]] = RUBRICS) -> DataFrame:
    """Records with at least ``threshold`` of their metrics; all records if it is 0 or less. Null scores have none."""
    return df if threshold <= 0 else df.where(F.coalesce(present_share(rubric, rubrics), F.lit(0.0)) >= threshold)


def completeness_counts(df: DataFrame, rubric: Column, threshold: float = 0.7, rubrics: Mapping[str, Sequence[str]] = RUBRICS) -> DataFrame:
    """(records, kept, dropped): what ``drop_incomplete`` leaves and drops, in one row."""
    kept = F.lit(True) if threshold <= 0 else F.coalesce(present_share(rubric, rubrics), F.lit(0.0)) >= threshold
    return df.agg(F.count("*").alias("records"), F.count_if(kept).alias("kept"), F.count_if(~kept).alias("dropped"))


def coverage(df: DataFrame, label: Column, goal: int = 1000, levels: int = 5, metrics: Sequence[str] | None = None) -> DataFrame:
    """(top, metric, level, records, missing): how many records each label has at each level of each metric.

    Level 1 to ``levels`` cuts [0, 1] evenly. Every label that occurs has a row for each of ``metrics`` (those of all
    rubrics) and levels, with 0 records where there is none; other metrics have rows where they occur.
    """
    rows = df.select(label.alias("top"), F.explode("scores").alias("metric", "score")).where("score is not null")
    level = F.greatest(F.lit(1), F.least(F.lit(levels), F.floor(F.col("score") * levels).cast("int") + 1))
    counted = rows.groupBy("top", "metric", level.alias("level")).agg(F.count("*").alias("records"))
    keys = F.array(*map(F.lit, metrics if metrics is not None else namespaced()))
    cells = df.select(label.alias("top")).distinct().select("top", F.explode(keys).alias("metric")).select("*", F.explode(F.sequence(F.lit(1), F.lit(levels))).alias("level"))
    every = cells.withColumn("records", F.lit(0).cast("bigint")).unionByName(counted).groupBy("top", "metric", "level").agg(F.sum("records").alias("records"))
    return every.withColumn("missing", F.greatest(F.lit(0).cast("bigint"), goal - F.col("records")))
