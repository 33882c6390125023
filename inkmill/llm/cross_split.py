"""Problem 6: texts of the evaluation splits that also occur in the train split, exactly or almost.

Every text gets a bit fingerprint: eight bits of each of 200 min-wise registers over its word sequences, 1,600 bits
whose Hamming distance grows with the dissimilarity. The fingerprint and a permutation of it are cut into 80 code blocks of
40 bits; blocks are joined across the splits only, pairs beyond the Hamming radius on that same fingerprint are dropped,
the rest is verified on the word sequences. (The README has the figures for signs of random projections.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.near_duplicates import RADIUS, candidate_pairs, fingerprints, keyed, similar_texts
from inkmill.llm.shared import materialize, slug

SPLITS = ("train", "validation", "test")


def clean_splits(splits: DataFrame) -> DataFrame:
    """(id, split) with one row per id; null and unknown splits are left out; the smallest wins if rows disagree."""
    named = splits.select("id", slug(F.col("split")).alias("split")).where(F.col("id").isNotNull() & F.col("split").isin(*SPLITS))
    return named.groupBy("id").agg(F.min("split").alias("split"))


def cross_split_pairs(records: DataFrame, splits: DataFrame, *, similarity: float = 0.5, sequence: int = 3, min_words: int = 60, radius: int = RADIUS) -> DataFrame:
    """(id_a, id_b, split_a, split_b): near-duplicate record pairs, id_a < id_b, one in train, one in validation or test.

    Ids without a split, null ids, null responses and responses under ``min_words`` words take no part. Repeated rows
    count once. Empty tables give no rows. Further columns of either table are ignored.
    """
    sides = clean_splits(splits)
    rows = keyed(records)
    keys = rows.select("id", "text_key").distinct().join(sides, "id")
    marks = keys.groupBy("text_key").agg(F.bit_or(F.when(F.col("split") == "train", 1).otherwise(2)).alias("side"))
    prints = materialize(fingerprints(rows, words=sequence, min_words=min_words, weighted=False).join(marks, "text_key"), "prints")
    links, members = similar_texts(rows, similarity=similarity, sequence=sequence, min_words=min_words, pairs=candidate_pairs(prints, radius))
    members = members.join(sides, "id")
    a = members.select(F.col("text_key").alias("a"), F.col("id").alias("x"), F.col("split").alias("sx"))
    b = members.select(F.col("text_key").alias("b"), F.col("id").alias("y"), F.col("split").alias("sy"))
    pairs = links.join(a, "a").join(b, "b").where("x <> y and (sx = 'train') <> (sy = 'train')")
    low = F.col("x") < F.col("y")
    named = [F.when(low, F.col(p)).otherwise(F.col(q)).alias(n) for n, p, q in (("id_a", "x", "y"), ("id_b", "y", "x"), ("split_a", "sx", "sy"), ("split_b", "sy", "sx"))]
    return pairs.select(*named).distinct()


def overlap_report(records: DataFrame, splits: DataFrame, **parameters: object) -> DataFrame:
    """(split, source, records, pairs): evaluation records with a train copy, and their pairs, by split and source."""
    pairs = cross_split_pairs(records, splits, **parameters)
    held = pairs.select(F.when(F.col("split_a") == "train", F.col("id_b")).otherwise(F.col("id_a")).alias("id"), F.when(F.col("split_a") == "train", F.col("split_b")).otherwise(F.col("split_a")).alias("split"))
    source = records.where("id is not null").groupBy("id").agg(F.min(slug(F.col("source_dataset_name"))).alias("source"))
    counted = held.groupBy("id", "split").agg(F.count("*").alias("pairs"))
    return counted.join(source, "id").groupBy("split", "source").agg(F.count("*").alias("records"), F.sum("pairs").alias("pairs"))
