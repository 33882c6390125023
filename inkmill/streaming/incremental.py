"""Records that keep arriving: the batch operators on Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from inkmill.operators.filters import FilterSettings, not_blacklisted, text_hash, token_range
from inkmill.operators.finalize import split_of


def read_stream(spark: SparkSession, folder: str, schema: str, files_a_trigger: int = 100) -> DataFrame:
    """Parquet files of a folder as they appear."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_trigger).parquet(folder)


def filtered(df: DataFrame, settings: FilterSettings, arrival: str = "ingested_at", late: str = "30 days") -> DataFrame:
    """Length and pattern filters, and the first row of each text within ``late`` of its arrival.

    The state holds one hash a text and is dropped once the watermark has passed; rows later than that are lost.
    """
    kept = df.where(token_range(settings.min_tokens, settings.max_tokens)).where(not_blacklisted(F.col("response"), settings.blacklist))
    return kept.withColumn("text_hash", text_hash(F.col("response"))).withWatermark(arrival, late).dropDuplicatesWithinWatermark(["text_hash"])


def split_counts(df: DataFrame, arrival: str = "ingested_at", late: str = "30 days", window: str = "7 days") -> DataFrame:
    """(start, split, records) by windows of arrival."""
    marked = df.select(F.col(arrival), split_of(F.col("id")).alias("split")).withWatermark(arrival, late)
    counted = marked.groupBy(F.window(arrival, window).alias("w"), "split").agg(F.count("*").alias("records"))
    return counted.select(F.col("w.start").alias("start"), "split", "records")


def append_new(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """A sink that appends to a Parquet table the rows whose id it doesn't hold yet; a batch replayed adds nothing."""

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fresh = batch.where("id is not null").dropDuplicates(["id"])
        if target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
            fresh = fresh.join(spark.read.parquet(path).select("id"), "id", "left_anti").select(*batch.columns)
        fresh.write.mode("append").parquet(path)

    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
