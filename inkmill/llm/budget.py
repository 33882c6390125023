"""Problem 5: tokens per source, language and label or genre, each distinct text tokenized once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmill.llm.encoding import token_counts
from inkmill.llm.shared import language, slug


def _label(c: Column) -> Column:
    """Clean label; values that name none (a fixed list) are null."""
    s = slug(c)
    return F.when(~s.isin("unknown", "other", "misc", "none", "n/a"), s)


def record_slices(records: DataFrame) -> DataFrame:
    """(part, source, lang, domain, text): one row per distinct record id, its first ingested row."""
    order = F.struct("ingested_at", F.xxhash64("response"))
    fields = F.struct(slug(F.col("source_dataset_name")).alias("source"), language(F.col("meta.lang")).alias("lang"), _label(F.col("classification.top")).alias("domain"), F.xxhash64("response").alias("text_key"))
    kept = records.where("id is not null").groupBy("id").agg(F.min_by(fields, order).alias("r"))
    return kept.select(F.lit("records").alias("part"), "r.*")


def document_slices(documents: DataFrame) -> DataFrame:
    """The same for documents, which have no redelivered rows: doc_id is unique."""
    return documents.select(F.lit("documents").alias("part"), slug(F.col("source")).alias("source"), language(F.col("lang")).alias("lang"), _label(F.col("genre")).alias("domain"), F.xxhash64("text").alias("text_key"))


def token_budget(records: DataFrame, documents: DataFrame, path: str | None = None) -> DataFrame:
    """(part, source, lang, domain, texts, distinct_texts, tokens, distinct_tokens) for records and documents.

    texts and tokens count every record id or document, distinct_* each text of a slice once. Spellings of sources,
    languages and labels are merged; what names none is null. Null and blank texts are not usable and count nowhere,
    so a slice of such texts alone has no row. Tokens are those of the given public tokenizer, without special tokens.
    """
    texts = records.select(F.col("response").alias("text")).unionByName(documents.select("text")).where(F.length(F.trim(F.regexp_replace("text", r"[\s ]+", " "))) > 0)
    # the copies of a text meet before and after the shuffle, so a hot text costs one row a task
    distinct = texts.groupBy(F.xxhash64("text").alias("text_key")).agg(F.first("text").alias("text"))
    counts = token_counts(distinct, path)
    slices = record_slices(records).unionByName(document_slices(documents))
    held = slices.groupBy("part", "source", "lang", "domain", "text_key").agg(F.count("*").alias("n"))
    joined = held.join(counts, "text_key")
    return joined.groupBy("part", "source", "lang", "domain").agg(
        F.sum("n").alias("texts"), F.count("*").alias("distinct_texts"), F.sum(F.col("n") * F.col("tokens")).alias("tokens"), F.sum("tokens").alias("distinct_tokens")
    )
