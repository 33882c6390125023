"""Materialised intermediates and small column helpers of the llm operators."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_WRITTEN: list[tuple[object, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where it is unset, a session in one process (tests) gets a
    folder of its own; on a cluster that raises, as no machine's own folder would do."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="inkmill-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files behind a materialised table that nothing reads any more."""
    for spark, path in list(_WRITTEN):
        if any(path in f for f in df.inputFiles()[:1]):
            _delete(spark, path)
            _WRITTEN.remove((spark, path))


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _clean() -> None:
    for spark, path in _WRITTEN:
        try:
            _delete(spark, path)
        except Exception:  # the session may be gone already
            pass


def small(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast when a materialised table has at most ``rows`` rows; a shuffle join otherwise."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def join_sizes(rows: DataFrame, sizes: DataFrame, key: str, *, count: str = "n", hot: int = 100_000, how: str = "inner") -> DataFrame:
    """Join rows with the one row that ``sizes`` (a written table) has for their key, with ``count`` rows of the key.

    Keys with over ``hot`` rows go by broadcast, so their rows stay where they are: no task gets all rows of one key.
    There are at most rows / hot of them; from a million on they are joined by shuffle like the rest.
    """
    heavy = sizes.where(F.col(count) > hot)
    if heavy.isEmpty():
        return rows.join(sizes, key, how)
    marked = rows.join(small(heavy.withColumn("_heavy", F.lit(True)), 1_000_000), key, "left")
    rest = marked.where("_heavy is null").select(*rows.columns).join(sizes.where(F.col(count) <= hot), key, how)
    return marked.where("_heavy").drop("_heavy").unionByName(rest)


def slug(c: Column) -> Column:
    """One spelling of a name or label: trimmed, lower case, runs of blanks, - and _ as one _; null when blank."""
    s = F.regexp_replace(F.trim(F.lower(F.regexp_replace(c, r"[\s ]+", " "))), r"[-_ ]+", "_")
    return F.when(s != "", s)


def language(c: Column) -> Column:
    """Two-letter code of a language in any of its spellings; null when the value names none.

    The spellings are fixed values: ISO codes of two and three letters, regional tags, English names.
    """
    s = slug(c)
    names = {
        "en": ["en", "eng", "english"],
        "fr": ["fr", "fra", "fre", "french", "français", "francais"],
        "de": ["de", "deu", "ger", "german", "deutsch"],
        "es": ["es", "spa", "spanish", "español", "espanol"],
    }
    head = F.substring_index(s, "_", 1)
    out = F.lit(None).cast("string")
    for code, spelled in names.items():
        out = F.when(head.isin(spelled), code).otherwise(out)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


