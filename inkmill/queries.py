"""Queries of the core operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.functions import templates
from inkmill.functions.ids import record_id
from inkmill.functions.language import language_of
from inkmill.functions.text import clean_text, head, one_line, token_count, truncate_prompt
from inkmill.operators import calibrate, filters, finalize, labels, ledger, prompts, scoring, segment
from inkmill.plans.backend import StubBackend
from inkmill.plans.config import Dataset, Settings
from inkmill.plans.pipeline import Chain, working_folder
from inkmill.sources import ingest, readers
from inkmill.sources.index import first_of

Query = Callable[[SparkSession, str], DataFrame]

#: Parameters of the queries, as small as the texts of the test tables make informative.
FILTER = filters.FilterSettings(min_tokens=60, max_tokens=1200, lang_threshold=0.9, blacklist=(r"<p>", r"isbn [0-9]"))
CHUNK_TOKENS, OVERLAP = 120, 1
QUOTAS, DEFAULT_QUOTA = {"poetry": 25, "other": 0}, 40
RULES = [("story_*", "narrative_creative"), ("poetry", "narrative_creative"), ("[fghn]*_*", "academic_informative"), ("blog_pos?", "entertainment_personal"), ("memoir", "professional"), ("*", "default")]

#: What the pipeline ingests, in this order.
PIPELINE_SOURCES = (Dataset("documents", "documents.parquet", "parquet", "C", {"id": "doc_id"}), Dataset("conversations", "conversations.parquet", "parquet", "A"))


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def unique_records(df: DataFrame) -> DataFrame:
    """Each record once: of rows delivered again, the first that came in."""
    return first_of(df.where("id is not null"), F.col("id"), ["ingested_at"])


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return ingest.ingest_texts(_t(spark, d, "documents"), "documents", id_column="doc_id", order=["doc_id"], path_column="source_path")


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return ingest.ingest_conversations(_t(spark, d, "conversations"), "conversations", order=["ingested_at", "id"])


def _records(spark: SparkSession, d: str) -> DataFrame:
    return unique_records(_t(spark, d, "records"))


def _lang_rows(spark: SparkSession, d: str) -> DataFrame:
    """Documents as filter input."""
    return _t(spark, d, "documents").select("doc_id", F.col("source").alias("source_dataset_name"), F.col("text").alias("response"))


def _detected() -> dict:
    lang, probability = language_of(F.col("response"))
    return {"lang": lang, "probability": probability}


def _replies(spark: SparkSession, d: str, stage: str) -> DataFrame:
    return _t(spark, d, "judge_replies").where(F.col("stage") == stage).withColumn("content", scoring.completion(F.col("envelope")))


def _latest(replies: DataFrame) -> DataFrame:
    """The last reply to each record and rubric."""
    return replies.groupBy("record_id", "rubric").agg(F.max_by(F.struct("reply_id", "content"), F.struct("received_at", "reply_id")).alias("r")).select("record_id", "rubric", "r.*")


def _scores(spark: SparkSession, d: str) -> DataFrame:
    parsed = _replies(spark, d, "score").withColumn("scores", scoring.parse_scores(F.col("content"), F.col("rubric")))
    return parsed.select("reply_id", F.explode("scores").alias("metric", "score"))


def _rubric() -> object:
    return scoring.route(F.col("classification.top"), RULES)


def _chunks(spark: SparkSession, d: str, overlap: int) -> DataFrame:
    docs = segment.with_chunks(_t(spark, d, "documents").where("text is not null").select("doc_id", "text"), "text", CHUNK_TOKENS, overlap)
    return docs.select("doc_id", F.posexplode("_c").alias("chunk", "p")).select("doc_id", "chunk", F.col("p.start").alias("start_pos"), F.col("p.end").alias("end_pos"))


def _segmented(spark: SparkSession, d: str) -> DataFrame:
    out = segment.segment(_documents(spark, d), CHUNK_TOKENS, 0)
    return out.select("id", "response", F.try_element_at("meta.char_span", F.lit(1)).alias("start_pos"), F.try_element_at("meta.char_span", F.lit(2)).alias("end_pos"))


def _pairs_to_splits(spark: SparkSession, d: str) -> DataFrame:
    kept = filters.filter_chain(_pairs(spark, d), filters.FilterSettings(min_tokens=10, max_tokens=2000), ["id"])
    return finalize.split_report(finalize.assign_splits(kept))


def _pipeline(spark: SparkSession, d: str) -> DataFrame:
    """All stages of plans/pipeline.py with the stub backend, over documents and conversations: ingest, filter, segment,
    classify, normalise, reconstruct, score, calibrate, completeness and split; counts per split and rubric.

    Settings are those of production but for the chunk size; the language filter takes the core's own detector.
    """
    settings = Settings(datasets=PIPELINE_SOURCES, rubric_mapping=dict(RULES), max_chunk_tokens=CHUNK_TOKENS, sentence_overlap=OVERLAP)
    backend = StubBackend(settings.genres, sorted({m for ms in scoring.RUBRICS.values() for m in ms}))
    chain = Chain(spark, settings, backend, working_folder(spark, "pipeline"))
    split = chain.final(ingest.union_records(_documents(spark, d), _pairs(spark, d))).withColumn("rubric", _rubric())
    return split.groupBy("split", "rubric").agg(F.count("*").alias("records"), F.count_if(F.col("meta.prompt_type") == "reconstructed").alias("reconstructed"))


def queries() -> dict[str, Query]:
    hashed = lambda c: F.sha2(c, 256).alias("prompt_hash")
    metrics = {name: [(m, f"Rate the text for {m.replace('_', ' ')}.", m.replace("_", " ")) for m in ms] for name, ms in scoring.RUBRICS.items()}
    q: dict[str, Query] = {
        "ingest_standalone": lambda s, d: ingest.ingest_texts(_t(s, d, "documents"), "documents", id_column="doc_id", order=["doc_id"]).select("id", "response", F.col("meta.original_id").alias("original_id")),
        "ingest_longform": lambda s, d: _documents(s, d).select("id", F.length("response").alias("chars"), F.col("meta.source_path").alias("source_path")),
        "ingest_pairs": lambda s, d: _pairs(s, d).select("id", "prompt", "response", F.col("meta.original_id").alias("original_id"), F.col("meta.prompt_type").alias("prompt_type")),
        "union_sources": lambda s, d: ingest.union_records(_documents(s, d), _pairs(s, d)).groupBy("source_dataset_name").agg(F.count("*").alias("records"), F.count("prompt").alias("prompts")),
        "limit_int": lambda s, d: readers.limited(_t(s, d, "documents"), 25, ["doc_id"]).select("doc_id", "source"),
        "limit_percent": lambda s, d: readers.limited(_t(s, d, "documents"), "12.5%", ["doc_id"]).select("doc_id", "source"),
        "clean_text": lambda s, d: _t(s, d, "documents").select("doc_id", clean_text(F.col("text")).alias("text")),
        "one_line": lambda s, d: _t(s, d, "documents").select("doc_id", one_line(F.col("text")).alias("text")),
        "record_ids": lambda s, d: _t(s, d, "documents").select("doc_id", record_id(F.lit("docs"), F.lit(None).cast("string"), F.col("text"), F.col("doc_id") % 3).alias("id")),
        "token_count": lambda s, d: _t(s, d, "documents").select("doc_id", token_count(F.col("text")).cast("bigint").alias("tokens")),
        "filter_length": lambda s, d: _t(s, d, "documents").where(filters.token_range(FILTER.min_tokens, FILTER.max_tokens, "text")).select("doc_id"),
        "filter_language": lambda s, d: _lang_rows(s, d).where(filters.in_language(*language_of(F.col("response")), FILTER.lang_threshold)).select("doc_id"),
        "filter_blacklist": lambda s, d: _lang_rows(s, d).where(filters.not_blacklisted(F.col("response"), FILTER.blacklist)).select("doc_id"),
        "dedup_exact": lambda s, d: filters.deduplicate(_lang_rows(s, d), ["doc_id"]).select("doc_id", "source_dataset_name"),
        "dedup_incremental": lambda s, d: filters.deduplicate_against(_lang_rows(s, d), filters.seen_hashes(_t(s, d, "records")), ["doc_id"]).select("doc_id"),
        "filter_chain": lambda s, d: filters.filter_chain(_lang_rows(s, d), FILTER, ["doc_id"], **_detected()).select("doc_id", "source_dataset_name"),
        "filter_counts": lambda s, d: filters.filter_counts(_lang_rows(s, d), FILTER, **_detected()),
        "sentences": lambda s, d: segment.sentences(_t(s, d, "documents"), "doc_id", "text").select("doc_id", F.col("n").cast("bigint").alias("n"), "sentence", F.col("tokens").cast("bigint").alias("tokens")),
        "segment_pack": lambda s, d: _chunks(s, d, 0),
        "segment_overlap": lambda s, d: _chunks(s, d, OVERLAP),
        "segment_chunks": _segmented,
        "classify_prompt": lambda s, d: _t(s, d, "documents").select("doc_id", hashed(templates.genre_prompt(head(F.col("text"), token_count(F.col("text"))), ["poetry", "memoir", "review"]))),
        "completion": lambda s, d: _t(s, d, "judge_replies").select("reply_id", scoring.completion(F.col("envelope")).alias("content")),
        "classify_parse": lambda s, d: _replies(s, d, "classify").select("reply_id", labels.parse_genre(F.col("content")).alias("top")),
        "class_counts": lambda s, d: labels.class_counts(_records(s, d)),
        "quota_sample": lambda s, d: labels.sample_quota(_records(s, d), QUOTAS, DEFAULT_QUOTA).select("id", labels.label_of().alias("top")),
        "prompt_gate": lambda s, d: _records(s, d).where(prompts.needs_prompt(150)).select("id"),
        "prompt_truncate": lambda s, d: _t(s, d, "documents").select("doc_id", truncate_prompt(F.col("text"), 256).alias("prompt")),
        "prompt_tag": lambda s, d: prompts.tag_prompts(_records(s, d), F.substring("response", 1, 400), most_tokens=150).select("id", "prompt", F.col("meta.prompt_type").alias("prompt_type")),
        "reconstruction_prompt": lambda s, d: _records(s, d).where(prompts.needs_prompt()).select("id", hashed(templates.reconstruction_prompt(F.col("response")))),
        "route_rubric": lambda s, d: _records(s, d).select("id", _rubric().alias("rubric")),
        "score_prompt": lambda s, d: _records(s, d).select("id", hashed(templates.scoring_prompt(F.col("response"), _rubric(), metrics))),
        "score_parse": _scores,
        "score_parse_native": lambda s, d: _replies(s, d, "score").select("reply_id", F.explode(scoring.parse_scores_native(F.col("content"), sorted({m for ms in scoring.RUBRICS.values() for m in ms}))).alias("metric", "score")),
        "resume_pending": lambda s, d: ledger.pending(_records(s, d), _t(s, d, "judge_replies").select(F.col("record_id").alias("id"))).select("id"),
        "resume_labels": lambda s, d: ledger.pending_labels(_records(s, d), _replies(s, d, "classify").select(F.col("record_id").alias("id"))).select("id"),
        "resume_scores": lambda s, d: ledger.pending_scores(_records(s, d), _replies(s, d, "score").select(F.col("record_id").alias("id"))).select("id"),
        "resume_merge": lambda s, d: ledger.merge_results(_records(s, d), _latest(_replies(s, d, "classify")).select(F.col("record_id").alias("id"), F.struct(labels.parse_genre(F.col("content")).alias("top"), F.lit(None).cast("string").alias("sub")).alias("classification")), ["classification"]).select("id", F.col("classification.top").alias("top")),
        "metric_percentiles": lambda s, d: calibrate.metric_percentiles(_records(s, d)).select("metric", "n", F.round("lo", 9).alias("lo"), F.round("hi", 9).alias("hi"), "least", "most"),
        "calibrate": lambda s, d: calibrate.calibrate(_records(s, d)).select("id", F.explode("scores").alias("metric", "score")).where(F.col("metric").endswith(calibrate.SUFFIX)).select("id", "metric", F.round("score", 7).alias("score")),
        "calibrate_degenerate": lambda s, d: calibrate.calibrate(_records(s, d).withColumn("scores", F.transform_values("scores", lambda k, v: F.when(v.isNotNull(), 0.25))), 5, 95).select("id", F.explode("scores").alias("metric", "score")).where(F.col("metric").endswith(calibrate.SUFFIX)),
        "completeness_filter": lambda s, d: calibrate.drop_incomplete(_records(s, d), calibrate.scored_rubric(), 0.7).select("id"),
        "completeness_counts": lambda s, d: calibrate.completeness_counts(_records(s, d), calibrate.scored_rubric(), 0.7),
        "split_assign": lambda s, d: finalize.assign_splits(_records(s, d)).select("id", "split"),
        "split_report": lambda s, d: finalize.split_report(finalize.assign_splits(_records(s, d))).select("split", "records", F.round("percent", 6).alias("percent")),
        "coverage_gap": lambda s, d: calibrate.coverage(_records(s, d), labels.label_of(), 20),
        "pairs_to_splits": lambda s, d: _pairs_to_splits(s, d).select("split", "records", F.round("percent", 6).alias("percent")),
        "pipeline_e2e": _pipeline,
    }
    return q
