"""Problem 4: a sample that follows target shares, by swap repair on counts of category signatures."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.llm.shared import materialize

#: Hash buckets a cell is cut into when its rows are drawn, and how often the bucket at the edge is cut again; only what
#: is left of it, a part in BUCKETS ** LEVELS of the cell, is ranked row by row.
BUCKETS, LEVELS = 4096, 2
#: Most target cells; they are handled in the driver.
MAX_CELLS = 100_000


def label(c: Column) -> Column:
    """Trimmed, lower case, - read as _."""
    return F.replace(F.lower(F.regexp_replace(c, r"^[\s ]+|[\s ]+$", "")), F.lit("-"), F.lit("_"))


def wanted(permille: int, floor: int, size: int) -> int:
    """Rows a cell should have: its share of the sample rounded up, at least its floor."""
    return max(floor, -(-permille * size // 1000))


def _deviation(n: np.ndarray, ideal: np.ndarray) -> np.ndarray:
    return (n - ideal) ** 2 / np.maximum(ideal, 1.0)


def random_draw(held: np.ndarray, size: int, rng: np.random.Generator) -> np.ndarray:
    """Rows of each cell in a random draw of ``size`` rows without replacement, for populations of any size.

    Every row is taken on its own by chance, which leaves a surplus or lack of about the root of the size; that is drawn
    in the same way from the rows taken or left, and so on until a few are left, which are drawn one by one.
    """
    taken, lack = np.zeros(len(held), np.int64), min(size, int(held.sum()))
    while abs(lack) > 1000:
        pool = held - taken if lack > 0 else taken
        taken = taken + int(np.sign(lack)) * rng.binomial(pool, abs(lack) / int(pool.sum()))
        lack = min(size, int(held.sum())) - int(taken.sum())
    while lack:
        pool = held - taken if lack > 0 else taken
        i = int(np.searchsorted(np.cumsum(pool), rng.integers(int(pool.sum())), "right"))
        taken[i] += int(np.sign(lack))
        lack -= int(np.sign(lack))
    return taken


def random_start(held: np.ndarray, floors: np.ndarray, size: int, rng: np.random.Generator) -> np.ndarray:
    """Counts of a random sample that holds the floors as far as rows and size go."""
    counts = np.minimum(held, floors)
    while counts.sum() > size:  # floors alone exceed the sample: give up the last rows of the largest floors
        counts[int(counts.argmax())] -= 1
    return counts + random_draw(held - counts, size - int(counts.sum()), rng)


def swap_repair(counts: np.ndarray, held: np.ndarray, floors: np.ndarray, ideal: np.ndarray) -> np.ndarray:
    """Exchange rows between cells as long as an exchange lowers the deviation from ``ideal``.

    Exchanges go in steps of halving size, the last of one row; the deviation is convex, so at the end none improves.
    No cell goes above what it holds or below its floor.
    """
    counts, low = counts.astype(np.int64).copy(), np.minimum(held, np.minimum(floors, counts))
    step = 1 << max(0, int(counts.sum()).bit_length() - 1)
    while step:
        now = _deviation(counts, ideal)
        out = np.where(counts - step >= low, now - _deviation(counts - step, ideal), -np.inf)
        into = np.where(counts + step <= held, now - _deviation(counts + step, ideal), -np.inf)
        a, b = int(out.argmax()), int(into.argmax())
        if a != b and out[a] + into[b] > 1e-9:
            counts[a] -= step
            counts[b] += step
        else:
            step //= 2
    return counts


def _cells(records: DataFrame, targets: DataFrame) -> tuple[DataFrame, list, int]:
    """(id, top, sub, cell) of every distinct id, the target rows, and the number of ids. cell -1: no target."""
    goals = targets.select("top", "sub", "target_permille", "min_rows").orderBy("top", "sub").limit(MAX_CELLS + 1).collect()
    if len(goals) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} target cells")
    # an id that is delivered again has the same labels; the smallest stands if not
    ids = records.where("id is not null").groupBy("id").agg(F.min(F.struct(label(F.col("classification.top")).alias("top"), label(F.col("classification.sub")).alias("sub"))).alias("c"))
    spark = records.sparkSession
    numbered = spark.createDataFrame([(g["top"], g["sub"], i) for i, g in enumerate(goals)], "top string, sub string, cell int")
    rows = ids.select("id", "c.top", "c.sub").join(F.broadcast(numbered), ["top", "sub"], "left")
    rows = materialize(rows.select("id", "top", "sub", F.coalesce("cell", F.lit(-1)).alias("cell")), "cells")
    return rows, goals, rows.count()


def _plan(rows: DataFrame, goals: list, total: int, fraction: float, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Counts held, wanted and taken of each target cell, and last of all other records; and the sample size."""
    size = math.floor(total * fraction + 1e-9)
    n = dict(rows.groupBy("cell").count().collect())
    held = np.array([n.get(i, 0) for i in [*range(len(goals)), -1]], np.int64)
    floors = np.array([g["min_rows"] for g in goals] + [0], np.int64)
    ideal = np.array([g["target_permille"] * size / 1000 for g in goals] + [0.0])
    start = random_start(held, floors, size, np.random.default_rng(seed))
    taken = swap_repair(start, held, floors, np.maximum(ideal, floors))
    want = np.array([wanted(g["target_permille"], g["min_rows"], size) for g in goals] + [0], np.int64)
    return held, want, taken, size


def stratified_sample(records: DataFrame, targets: DataFrame, fraction: float = 0.2, seed: int = 7) -> DataFrame:
    """(id, top, sub): a sample of floor(fraction x distinct ids) rows.

    Cells that hold too few rows give all they have and the rest is spread over the others; records outside all target
    cells (null labels too) come in only where the cells cannot fill the sample. Rows within a cell are drawn by
    hash, so the sample does not depend on row order. Null ids are left out; an empty table gives no rows.
    """
    rows, goals, total = _cells(records, targets)
    _, _, taken, _ = _plan(rows, goals, total, fraction, seed)
    spark = records.sparkSession
    quota = spark.createDataFrame([(i if i < len(goals) else -1, int(t)) for i, t in enumerate(taken)], "cell int, quota bigint")
    return drawn(rows.withColumn("h", F.xxhash64(F.lit(seed), "id")), quota).select("id", "top", "sub")


def drawn(rows: DataFrame, quota: DataFrame, buckets: int = BUCKETS, levels: int = LEVELS) -> DataFrame:
    """The rows of smallest ``h`` of each cell, as many as ``quota`` (cell, quota; at most MAX_CELLS rows) says.

    The highest bits of the hash cut a cell into buckets; those below the edge are taken after a count, the bucket at the
    edge is cut again by the next bits. A cell's edge and the room in it are one row, so what is sent is one row a cell.
    """
    bits = buckets.bit_length() - 1
    parts, rest = [], rows.withColumn("_h", F.expr("shiftright(h, 1) + shiftleft(cast(1 as bigint), 62)"))  # from 0 on
    for level in range(levels):
        rest = rest.withColumn("bucket", F.shiftright("_h", 63 - bits * (level + 1)).bitwiseAND(F.lit(buckets - 1)).cast("int"))
        sizes = rest.groupBy("cell", "bucket").count().join(F.broadcast(quota), "cell")
        upto = sizes.withColumn("above", F.expr("sum(count) over (partition by cell order by bucket rows between unbounded preceding and current row)"))
        edge = materialize(upto.groupBy("cell").agg(F.min(F.when(F.col("above") > F.col("quota"), F.struct("bucket", (F.col("quota") - F.col("above") + F.col("count")).alias("room")))).alias("e")), "edge")
        edge = edge.select("cell", F.coalesce("e.bucket", F.lit(buckets)).alias("edge"), F.col("e.room").alias("quota"))
        placed = rest.join(F.broadcast(edge.select("cell", "edge")), "cell")
        parts.append(placed.where("bucket < edge").select(*rows.columns))
        rest = placed.where("bucket = edge").drop("edge", "bucket")
        quota = edge.where("quota > 0").select("cell", "quota")
    last = rest.join(F.broadcast(quota), "cell").withColumn("r", F.expr("row_number() over (partition by cell order by h, id)")).where("r <= quota")
    return reduce(DataFrame.unionByName, [*parts, last.select(*rows.columns)])


def exhausted(taken: np.ndarray, held: np.ndarray, want: np.ndarray) -> np.ndarray:
    """Rows that each target cell lacks even after every exchange in its favour.

    The repair leaves cells a little under their targets where rounding up or floors ask for more rows than there are;
    each such cell is given rows in exchange for any other of the sample (the last entry is what lies outside all
    cells). What it then lacks, no exchange can give it.
    """
    lacks = np.zeros(len(taken), np.int64)
    for i in np.flatnonzero(taken < want):
        lacks[i] = max(0, int(want[i] - taken[i]) - min(int(held[i] - taken[i]), int(taken.sum() - taken[i])))
    return lacks


def sample_report(records: DataFrame, targets: DataFrame, fraction: float = 0.2, seed: int = 7) -> DataFrame:
    """(top, sub, held, wanted, taken, missing) of every target cell: what it holds, should give and gives, and what
    the repair could not place in it (0 where its records suffice)."""
    rows, goals, total = _cells(records, targets)
    held, want, taken, _ = _plan(rows, goals, total, fraction, seed)
    lacks = exhausted(taken, held, want)
    report = [(g["top"], g["sub"], int(h), int(w), int(t), int(x)) for g, h, w, t, x in zip(goals, held, want, taken, lacks)]
    return records.sparkSession.createDataFrame(report, "top string, sub string, held bigint, wanted bigint, taken bigint, missing bigint")


def short_cells(records: DataFrame, targets: DataFrame, fraction: float = 0.2, seed: int = 7) -> DataFrame:
    """(top, sub) of the cells for which the repaired sample and every exchange in their favour lack rows."""
    return sample_report(records, targets, fraction, seed).where("missing > 0").select("top", "sub")
