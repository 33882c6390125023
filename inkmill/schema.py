"""The record: the one table that every stage reads and writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

META = T.StructType(
    [
        T.StructField("prompt_type", T.StringType()),
        T.StructField("source_path", T.StringType()),
        T.StructField("char_span", T.ArrayType(T.IntegerType())),
        T.StructField("lang", T.StringType()),
        T.StructField("original_id", T.StringType()),
    ]
)
CLASSIFICATION = T.StructType([T.StructField("top", T.StringType()), T.StructField("sub", T.StringType())])
SCORES = T.MapType(T.StringType(), T.DoubleType(), True)
RECORD = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("source_dataset_name", T.StringType()),
        T.StructField("prompt", T.StringType()),
        T.StructField("response", T.StringType()),
        T.StructField("meta", META),
        T.StructField("classification", CLASSIFICATION),
        T.StructField("scores", SCORES),
    ]
)
PROMPT_TYPES = ("human", "synthetic", "reconstructed")


def to_records(df: DataFrame, *, source_path: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows (id, source_dataset_name, prompt, response, prompt_type, original_id[, source_path]) as records, with the columns of ``keep``."""
    meta = F.struct(
        F.col("prompt_type").cast("string").alias("prompt_type"),
        (F.col("source_path") if source_path else F.lit(None)).cast("string").alias("source_path"),
        F.lit(None).cast("array<int>").alias("char_span"),
        F.lit(None).cast("string").alias("lang"),
        F.col("original_id").cast("string").alias("original_id"),
    )
    empty = F.struct(F.lit(None).cast("string").alias("top"), F.lit(None).cast("string").alias("sub"))
    return df.select(
        "id",
        "source_dataset_name",
        F.col("prompt").cast("string").alias("prompt"),
        "response",
        meta.alias("meta"),
        empty.alias("classification"),
        F.create_map().cast(SCORES).alias("scores"),
        *keep,
    )
