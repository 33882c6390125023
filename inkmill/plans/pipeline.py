"""The stages in order, each a function from records to records, written to a folder of its own."""

from __future__ import annotations

import atexit
import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from inkmill.functions import language, templates, tokens
from inkmill.functions.text import head, token_count
from inkmill.operators import calibrate, filters, finalize, labels, ledger, prompts, scoring, segment
from inkmill.plans.backend import Backend
from inkmill.plans.config import Dataset, Settings
from inkmill.sources import ingest, readers
from inkmill.sources.index import shared_folder

LOG = logging.getLogger("inkmill")
#: The stages that ask a model, with the name under which its answers are kept.
ANSWERS = {"classify": "classification", "reconstruct": "prompt_reconstruction", "score": "scoring"}
#: The place of a record in its source, in the ingest artifact.
PLACE = StructType([StructField("_file", StringType()), StructField("_part", LongType()), StructField("_row", LongType())])
STAGES = ("ingest", "filter", "segment", "classify", "normalize", "reconstruct", "score", "finalize")


@dataclass
class Run:
    """A run in a folder. A stage whose output is complete is skipped unless forced; a broken one starts from what the
    model has already answered."""

    spark: SparkSession
    settings: Settings
    backend: Backend
    folder: str
    force: bool = False
    detector: Callable[[DataFrame], tuple[object, object]] | None = language.detect

    def __post_init__(self) -> None:
        path = self.settings.tokenizer
        self.count = tokens.counter(path) if path else token_count
        self.counter = tokens.lengths(path) if path else None

    def path(self, stage: str) -> str:
        return f"{self.folder.rstrip('/')}/{stage}"

    def read(self, stage: str) -> DataFrame:
        return readers.read_records(self.spark, self.path(stage), self.settings.artifact_format)

    def run(self, only: tuple[str, ...] = STAGES, skip: tuple[str, ...] = ()) -> None:
        """Run stages in order; the first that fails ends the run."""
        if unknown := sorted({*only, *skip} - set(STAGES)):
            raise ValueError(f"unknown stages {unknown}")
        for stage in STAGES:
            if stage in only and stage not in skip:
                self.stage(stage)

    def stage(self, name: str) -> None:
        if not self.force and readers.exists(self.spark, self.path(name)):
            LOG.info("stage %s has output in %s", name, self.path(name))
            return
        LOG.info("stage %s begins", name)
        if name == "ingest":
            return self._ingest_all()
        out = getattr(self, f"_{name}")()
        if name == "finalize":
            readers.write_splits(out, self.path(name), self.settings.artifact_format, "overwrite", self.settings.name_prefix)
        else:
            readers.write_records(out, self.path(name), self.settings.artifact_format, "overwrite")
        if name == "filter" and self.settings.dedup_store:
            filters.seen_hashes(self.read(name)).write.mode("append").parquet(self.settings.dedup_store)
        LOG.info("stage %s is complete", name)

    def clear(self, stage: str, dataset: str | None = None) -> None:
        """Forget what a stage has put out and what a model has answered for it, or of the ingest stage one dataset."""
        if stage not in STAGES or dataset is not None and stage != "ingest":
            raise ValueError("a stage, or a dataset of the ingest stage, can be cleared")
        if dataset is not None:
            readers.remove(self.spark, f"{self.path(stage)}/dataset={dataset}")
            readers.remove(self.spark, f"{self.path(stage)}/_SUCCESS")
            return
        readers.remove(self.spark, self.path(stage))
        if stage in ANSWERS:
            readers.remove(self.spark, self.path(f"answers/{ANSWERS[stage]}"))

    def _before(self, stage: str) -> DataFrame:
        """Output of the nearest earlier stage that has one: a stage left out passes its input on."""
        for name in reversed(STAGES[: STAGES.index(stage)]):
            if readers.exists(self.spark, self.path(name)):
                return self.read(name)
        raise FileNotFoundError(f"nothing to {stage}: no earlier stage has output in {self.folder}")

    def load(self, d: Dataset) -> DataFrame:
        """Records of a dataset, with the place of each in its source."""
        place = readers.POSITION
        raw = readers.read_source(self.spark, d.path, d.format, max_items=d.max_items, config=d.config, split=d.split, position=True)
        if d.format == "text_dir":
            return ingest.ingest_files(raw, d.name, place)
        key, order = d.columns.get("id"), list(place)
        if d.type == "A":
            return ingest.ingest_conversations(raw, d.name, column=d.columns.get("conversations", "conversations"), id_column=key or "id", order=order, keep=place)
        return ingest.ingest_texts(raw, d.name, text_column=d.columns.get("text", "text"), id_column=key, order=order, keep=place)

    def _ingest_all(self) -> None:
        """Each dataset in a folder of its own. One that fails is logged and left out; if all do, that raises. Those that are
        complete are not read again."""
        base, failed = self.path("ingest"), []
        for d in self.settings.datasets:
            part = f"{base}/dataset={d.name}"
            try:
                if self.force or not readers.exists(self.spark, part):
                    readers.write_records(self.load(d), part, self.settings.artifact_format, "overwrite")
            except Exception as e:  # whatever a source may raise
                LOG.error("dataset %s is left out: %s", d.name, str(e).split("\n")[0])
                readers.remove(self.spark, part)
                failed.append(d.name)
        if failed and len(failed) == len(self.settings.datasets):
            raise RuntimeError(f"no dataset could be read: {failed}")
        readers.mark(self.spark, base)

    def _placed(self) -> DataFrame:
        """What was ingested, with the place of each record in its source."""
        return readers.read_records(self.spark, self.path("ingest"), self.settings.artifact_format, PLACE)

    def _filter(self) -> DataFrame:
        self._before("filter")
        df, s = self._placed(), self.settings
        lang, probability = self.detector(df) if self.detector else (None, None)
        order = {d.name: i for i, d in enumerate(s.datasets)}
        place = F.create_map(*[F.lit(x) for kv in order.items() for x in kv]) if order else None
        rank = F.coalesce(F.try_element_at(place, F.col("source_dataset_name")), F.lit(len(order))) if order else F.lit(0)
        # the first seen of equal texts stays: by dataset, then by place in the source
        first = ["_o", *[c for c in readers.POSITION if c in df.columns], "id"]
        settings = replace(s.filter, counter=self.count)
        seen = self.spark.read.parquet(s.dedup_store) if s.dedup_store and readers.exists(self.spark, s.dedup_store) else None
        out = filters.filter_chain(df.withColumn("_o", rank), settings, first, lang=lang, probability=probability, seen=seen)
        return out.drop("_o", *readers.POSITION)

    def _segment(self) -> DataFrame:
        s = self.settings
        shape = {d.name for d in s.datasets if d.type == "C"}
        always = F.col("source_dataset_name").isin(*shape) if s.segment_shape_c and shape else None
        return segment.segment(self._before("segment"), s.max_chunk_tokens, s.sentence_overlap, always=always, count=self.count, counter=self.counter)

    def _answers(self, stage: str, requests: DataFrame, **options: float) -> DataFrame:
        """Answers to (id, request), from the answer table of the stage where it has them; new ones are added to it."""
        path = self.path(f"answers/{stage}")
        schema = "id string, content string"
        known = readers.exists(self.spark, path)
        # a call that failed has no answer and is made again
        done = self.spark.read.schema(schema).parquet(path).where("content is not null") if known else None
        missing = ledger.pending(requests, done)
        found = self.backend.answer(missing, stage, self.settings.model_for(stage), **options)
        found.where("content is not null").write.mode("append").parquet(path)
        return self.spark.read.schema(schema).parquet(path).where("content is not null").groupBy("id").agg(F.min("content").alias("content"))

    def _classify(self) -> DataFrame:
        df, genres = self._before("classify"), self.settings.genres
        text = head(F.col("response"), self.count(F.col("response")))
        asked = df.where("length(response) > 0 and classification.top is null").select("id", templates.genre_prompt(text, genres).alias("request"))
        answers = self._answers("classification", asked, temperature=0.0, max_tokens=20)
        label = F.struct(labels.parse_genre(F.col("content"), genres).alias("top"), F.lit(None).cast("string").alias("sub"))
        merged = ledger.merge_results(df.withColumn("classification", F.when(F.col("classification.top").isNotNull(), F.col("classification"))), answers.select("id", label.alias("classification")), ["classification"])
        unknown = F.struct(F.lit(labels.UNKNOWN).alias("top"), F.lit(None).cast("string").alias("sub"))
        return merged.withColumn("classification", F.coalesce("classification", unknown))

    def _normalize(self) -> DataFrame:
        s = self.settings
        return labels.sample_quota(self._before("normalize"), s.quotas, s.default_quota, seed=s.seed)

    def _reconstruct(self) -> DataFrame:
        df, s = self._before("reconstruct"), self.settings
        asked = df.where(prompts.needs_prompt(s.prompt_most_tokens, self.count)).select("id", templates.reconstruction_prompt(F.col("response")).alias("request"))
        answers = self._answers("prompt_reconstruction", asked, temperature=0.1, max_tokens=128)
        joined = df.join(answers, "id", "left")
        return prompts.tag_prompts(joined, F.col("content"), most_tokens=s.prompt_most_tokens, most_chars=s.prompt_most_chars, counter=self.count).drop("content")

    def _rubric(self) -> object:
        return scoring.route(F.col("classification.top"), self.settings.rubric_mapping or {"*": scoring.DEFAULT_RUBRIC}, self._metrics())

    def _metrics(self) -> dict[str, tuple[str, ...]]:
        return self.settings.metrics() or scoring.RUBRICS

    def _score(self) -> DataFrame:
        df = self._before("score").withColumn("_r", self._rubric())
        described = {n: [(m.name, m.description, m.prompt_hint) for m in ms] for n, ms in self.settings.rubrics.items()} or {n: [(m, m.replace("_", " "), "") for m in ms] for n, ms in scoring.RUBRICS.items()}
        asked = df.where(F.coalesce(F.size("scores"), F.lit(0)) <= 0).select("id", templates.scoring_prompt(F.col("response"), F.col("_r"), described).alias("request"))
        answers = self._answers("scoring", asked, temperature=0.0, max_tokens=2048)
        parsed = df.select("id", "_r").join(answers, "id").select("id", scoring.parse_scores(F.col("content"), F.col("_r"), self._metrics()).alias("scores"))
        held = df.withColumn("scores", F.when(F.size("scores") > 0, F.col("scores")))
        return ledger.merge_results(held, parsed, ["scores"]).withColumn("scores", F.coalesce("scores", F.create_map().cast("map<string,double>"))).drop("_r")

    def _finalize(self) -> DataFrame:
        s, df = self.settings, self._before("finalize")
        keys = scoring.namespaced(self._metrics())
        done = calibrate.calibrate(df, s.lower_percentile, s.upper_percentile, keys, s.calibrate)
        return finalize.assign_splits(calibrate.drop_incomplete(done, self._rubric(), s.min_metrics_present, self._metrics()), s.splits)


@dataclass
class Chain(Run):
    """The same stages over a table that is already ingested, handed on as plans. Only what a later stage reads more than
    once (KEPT) is written, to a folder of its own; answers are not, so the backend must answer alike each time."""

    KEPT = ("classify", "score")
    held: DataFrame | None = field(default=None, repr=False)

    def _before(self, stage: str) -> DataFrame:
        return self.held

    def _placed(self) -> DataFrame:
        return self.held

    def _answers(self, stage: str, requests: DataFrame, **options: float) -> DataFrame:
        return self.backend.answer(requests, stage, self.settings.model_for(stage), **options)

    def final(self, ingested: DataFrame) -> DataFrame:
        self.held = ingested
        for name in STAGES[1:]:
            out = getattr(self, f"_{name}")()
            if name in self.KEPT:
                readers.write_records(out, self.path(name), self.settings.artifact_format, "overwrite")
                out = self.read(name)
            self.held = out
        return self.held


def working_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share, in spark.checkpoint.dir, deleted at exit."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    @atexit.register
    def clean() -> None:
        try:
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session may be gone already
            pass

    return path
