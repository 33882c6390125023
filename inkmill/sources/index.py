"""Dense row numbers and the first rows of a source, without a single task that sees all rows."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most rows of a table that is broadcast.
MAX_SENT = 500_000

_LOCAL = (1 << 33) - 1


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage in the folder that the session names in spark.checkpoint.dir."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where it is unset, a session in one process (tests) gets one of its own; on a
    cluster that raises, as no machine's own folder would do."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="inkmill-")
    return folder


def sent(df: DataFrame, rows: int = MAX_SENT) -> DataFrame:
    """A checkpointed table with a broadcast hint while it has at most ``rows`` rows; beyond that it is joined by shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def first_of(df: DataFrame, key: Column, order: list[str] | tuple[str, ...]) -> DataFrame:
    """The first row in ``order`` of each value of ``key``; rows whose key is null count as one.

    Keys are counted first, alone; rows whose key comes once stay where they are. Only rows of repeated keys move, in an
    aggregate that combines them before the shuffle, so neither a frequent key nor long rows meet in one task.
    """
    keyed = df.withColumn("_key", F.coalesce(key.cast("string"), F.lit("")))
    again = sent(checkpointed(keyed.groupBy("_key").agg(F.count("*").alias("_n")).where("_n > 1").select("_key", F.lit(True).alias("_again"))))
    marked = keyed.join(again, "_key", "left")
    once = marked.where("_again is null").select(*df.columns)
    rows = F.struct(*df.columns)
    kept = marked.where("_again").groupBy("_key").agg(F.min_by(rows, F.struct(*order)).alias("_r")).select("_r.*")
    return once.unionByName(kept)


def with_row_index(df: DataFrame, order: list[str], name: str = "row_index") -> DataFrame:
    """Add the 0-based position of each row in the order of ``order`` (nulls first).

    Rows are sorted over all tasks by range; each then counts within its range, and the sizes of the ranges before it,
    one row a task, are added. Rows alike in all order columns follow one another in no fixed order.
    """
    placed = checkpointed(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).count()
    before = sizes.select("_part", F.expr("coalesce(sum(count) over (order by _part rows between unbounded preceding and 1 preceding), 0)").alias("_before"))
    joined = placed.withColumn("_part", part).join(F.broadcast(before), "_part")
    return joined.withColumn(name, (F.col("_before") + F.col("_at").bitwiseAND(F.lit(_LOCAL))).cast("bigint")).drop("_part", "_before", "_at")


def first_rows(df: DataFrame, order: list[str] | None, rows: int) -> DataFrame:
    """The first rows in an order (a top-n, each task sends its best), or in the order of the files."""
    return df.orderBy(*order).limit(rows) if order else df.limit(rows)
