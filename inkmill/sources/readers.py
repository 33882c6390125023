"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from inkmill.functions.text import strip
from inkmill.schema import RECORD
from inkmill.sources.index import first_rows

#: Columns that tell the place of a row in its source.
POSITION = ("_file", "_part", "_row")
FORMATS = ("parquet", "arrow", "hf_dataset", "jsonl", "json", "csv", "text", "text_dir")


def parse_limit(limit: int | str | None) -> tuple[int | None, float | None]:
    """(rows, percent) of a limit given as a number, ``"25%"`` or nothing."""
    if limit is None:
        return None, None
    if isinstance(limit, str) and limit.strip().endswith("%"):
        return None, float(limit.strip()[:-1])
    return int(limit), None


def limited(df: DataFrame, limit: int | str | None, order: list[str] | None = None) -> DataFrame:
    """The first rows of a source: a number of them, or a percentage rounded down (0 rows if that is 0).

    ``order`` names the columns that settle which rows are first; without it, it is the order of the files.
    """
    rows, percent = parse_limit(limit)
    if percent is not None:
        rows = int(df.count() * percent / 100)
    if rows is None:
        return df
    return first_rows(df, order, rows)


def read_source(spark: SparkSession, path: str, fmt: str, *, schema: StructType | str | None = None, max_items: int | str | None = None, order: list[str] | None = None, strict: bool = False, strip_lines: bool = False, config: str | None = None, split: str | None = None, position: bool = False) -> DataFrame:
    """Read a dataset in one of FORMATS.

    jsonl: one object a line, malformed lines are skipped, or raise if ``strict``. csv: header, quotes doubled, line
    feeds within quotes. text: one row a line, column ``text``. text_dir: one row for each ``*.txt`` file of
    the folder (not below it), columns ``text``, ``file_name``, ``source_path``; ``max_items`` counts files in the
    order of their names. arrow and hf_dataset read Parquet exports; of the latter, ``config`` names a folder below the path
    and ``split`` the files that begin with it, at any depth. Missing paths raise.

    ``strip_lines`` strips the lines of a text and drops the blank ones. ``position`` adds POSITION, the place of each row:
    its file, the place of the file's part, and a number that grows within the part.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; known: {', '.join(FORMATS)}")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if fmt == "hf_dataset" and (config or split):
        path = f"{path.rstrip('/')}/{config}" if config else path
        reader = reader.option("recursiveFileLookup", "true")
        reader = reader.option("pathGlobFilter", f"{split}*.parquet") if split else reader
    if fmt in ("parquet", "arrow", "hf_dataset"):
        df = reader.parquet(path)
    elif fmt in ("jsonl", "json"):
        df = reader.json(path, mode="FAILFAST" if strict else "DROPMALFORMED", multiLine=False)
    elif fmt == "csv":
        df = reader.csv(path, header=True, multiLine=True, escape='"')
    elif fmt == "text":
        df = spark.read.text(path).withColumnRenamed("value", "text")
        if strip_lines:
            df = df.withColumn("text", strip(F.col("text"))).where("text <> ''")
    else:
        df = spark.read.text(path, wholetext=True, pathGlobFilter="*.txt")
        df = df.select(F.col("value").alias("text"), F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_path").alias("source_path"), *([F.col("_metadata")] if position else []))
        order = order or ["file_name"]
    if position:
        df = df.withColumns(dict(zip(POSITION, (F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()))))
        df, order = df.drop("_metadata") if fmt == "text_dir" else df, order or list(POSITION)
    return limited(df, max_items, order)


def read_records(spark: SparkSession, path: str, fmt: str = "parquet", more: StructType | None = None) -> DataFrame:
    """Records of an artifact, always in the fixed schema (and the columns of ``more``); a malformed JSON line raises.

    An artifact that is missing or has no rows is an empty table.
    """
    schema = StructType([*RECORD.fields, *(more.fields if more else [])])
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    df = reader.parquet(path) if fmt == "parquet" else reader.json(path, mode="FAILFAST")
    return df.select(*schema.names)


def write_records(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Write an artifact: Parquet, or JSON lines that keep null fields. Empty maps are written as they are."""
    writer = df.write.mode(mode)
    if fmt == "parquet":
        writer.parquet(path)
    else:
        writer.option("ignoreNullFields", "false").json(path)


def write_splits(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists", prefix: str | None = None) -> None:
    """One folder for each split that has rows, in one pass over the records (column ``split``).

    With a prefix the folders are ``name=prefix.split``, else ``split=...``.
    """
    named = df if prefix is None else df.withColumn("name", F.concat(F.lit(f"{prefix}."), "split")).drop("split")
    writer = named.write.mode(mode).partitionBy("split" if prefix is None else "name")
    if fmt == "parquet":
        writer.parquet(path)
    else:
        writer.option("ignoreNullFields", "false").json(path)


def read_split(spark: SparkSession, path: str, split: str, fmt: str = "parquet", prefix: str = "final") -> DataFrame:
    """The records of one split that ``write_splits`` wrote with a prefix."""
    return read_records(spark, f"{path}/name={prefix}.{split}", fmt)


def mark(spark: SparkSession, path: str) -> None:
    """Note that an artifact of several parts is complete."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True).close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete an artifact; nothing happens where there is none."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether an artifact was written to its end."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
