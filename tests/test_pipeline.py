import http.server
import json
import threading

from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from inkmill.functions import tokens
from inkmill.operators import scoring
from inkmill.operators.filters import FilterSettings
from inkmill.plans import cli
from inkmill.plans.backend import HttpBackend, StubBackend, call
from inkmill.plans.config import Dataset, Metric, ModelSettings, Settings, load_settings
from inkmill.plans.pipeline import STAGES, Run
from inkmill.streaming import incremental

RUN = """
seed: 5
preprocessing: {filter: {min_response_tokens: 2, max_response_tokens: 500, lang_id_threshold: 0}, segmentation: {max_chunk_tokens: 30, sentence_overlap_count: 1}}
classification: {model_name: own, top_level_genres_for_prompt: [poetry, story_x], llm_settings: {max_retries: 0}}
normalization: {quotas: {class.top: {poetry: 5}}, default_quota_per_class: 7}
rubric_mapping: {"story_*": fancy, "*": default}
default_llm_settings: {model_name: base, max_retries: 2, timeout_seconds: 9}
postprocessing: {min_metrics_present_percent: 0.5}
"""
RUBRIC = "name: {0}\nmetrics:\n  - {{name: depth, description: d, prompt_hint: h}}\n  - {{name: tone, description: d, prompt_hint: h}}\n"


@pytest.fixture
def files(tmp_path):
    (tmp_path / "rubrics").mkdir()
    for name in ("default", "fancy"):
        (tmp_path / "rubrics" / f"{name}.yaml").write_text(RUBRIC.format(name))
    (tmp_path / "run.yaml").write_text(RUN)
    (tmp_path / "texts.txt").write_text("".join(f"Text number {i} is here. It says {i}.\n" for i in range(40)) + "Text number 1 is here. It says 1.\n")
    (tmp_path / "datasets.yaml").write_text(f"datasets:\n  - {{name: lines, path: {tmp_path}/texts.txt, format: text, type: B}}\n")
    return tmp_path


def test_settings(files):
    s = load_settings(files / "run.yaml", files / "datasets.yaml", files / "rubrics")
    assert s.filter == FilterSettings(2, 500, 0, ()) and s.quotas == {"poetry": 5} and list(s.rubrics) == ["default", "fancy"]
    got = s.model_for("classification")
    assert (got.model_name, got.max_retries, got.timeout_seconds) == ("base", 0, 9)
    assert Settings(stage_model_names={"scoring": "own"}).model_for("scoring").model_name == "own"
    with pytest.raises(ValueError):
        Settings(rubrics={"default": (Metric("a"),)}, rubric_mapping={"*": "none"})
    with pytest.raises(ValueError):
        Dataset("x", "p", "xml", "A")
    (files / "rubrics" / "z.yaml").write_text(RUBRIC.format("fancy"))
    with pytest.raises(ValueError):
        load_settings(files / "run.yaml", files / "datasets.yaml", files / "rubrics")


def test_run_and_resume(spark, files):
    out = str(files / "out")
    args = ["--run", str(files / "run.yaml"), "--datasets", str(files / "datasets.yaml"), "--rubrics", str(files / "rubrics"), "--folder", out, "--stub"]
    assert cli.main(args) == 0
    final = spark.read.parquet(f"{out}/finalize")
    rows = final.collect()
    assert 0 < len(rows) <= 12 and {r["classification"]["top"] for r in rows} <= {"poetry", "story_x"}
    assert all(any(k.startswith("fancy." if r["classification"]["top"] == "story_x" else "default.") for k in r["scores"]) for r in rows)
    assert all(0 <= v <= 1 for r in rows for v in r["scores"].values() if v is not None)
    assert cli.main(args) == 0 and spark.read.parquet(f"{out}/finalize").count() == len(rows)
    with pytest.raises(ValueError):
        cli.main([*args, "nothing"])
    assert set(STAGES) == {"ingest", "filter", "segment", "classify", "normalize", "reconstruct", "score", "finalize"}


def test_run_folder_and_failing_dataset(spark, files):
    (files / "datasets.yaml").write_text(f"datasets:\n  - {{name: gone, path: {files}/gone.txt, format: text, type: B}}\n  - {{name: lines, path: {files}/texts.txt, format: text, type: B}}\n")
    args = ["--run", str(files / "run.yaml"), "--datasets", str(files / "datasets.yaml"), "--rubrics", str(files / "rubrics"), "--runs", str(files / "runs"), "--stub", "ingest", "filter"]
    assert cli.main(args) == 0
    folder = next((files / "runs").iterdir())
    assert folder.name.startswith("run_") and (folder / "config" / "rubrics" / "fancy.yaml").exists()
    assert "dataset gone is left out" in (folder / "logs" / "pipeline.log").read_text()
    kept = spark.read.parquet(f"{folder}/filter")
    # equal texts: the first of the source stays
    assert kept.count() == 40 and kept.where("response = 'Text number 1 is here. It says 1.'").first()["meta"]["original_id"] == "item_1"
    (files / "run.yaml").write_text("nonsense: [")
    assert cli.main(["--resume", str(folder), "--stub", "--clear", "filter", "--", "segment"]) == 0
    assert not (folder / "filter").exists() and (folder / "segment" / "_SUCCESS").exists()
    (files / "only.yaml").write_text(f"datasets:\n  - {{name: gone, path: {files}/gone.txt, format: text, type: B}}\n")
    s = load_settings(folder / "config" / "run.yaml", files / "only.yaml", files / "rubrics")
    with pytest.raises(RuntimeError):
        Run(spark, s, StubBackend(s.genres, ["depth"]), str(files / "none")).stage("ingest")


def test_store_of_earlier_runs_and_failed_answers(spark, files):
    s = replace(load_settings(files / "run.yaml", files / "datasets.yaml", files / "rubrics"), dedup_store=str(files / "seen"))

    class Flaky(StubBackend):
        asked = []

        def answer(self, df, stage, settings, **options):
            out = super().answer(df, stage, settings, **options)
            Flaky.asked.append(out.count())
            return out.withColumn("content", F.when(F.lit(len(Flaky.asked) > 1) | ~F.col("id").startswith("sha256:1"), F.col("content")))

    run = Run(spark, s, Flaky(s.genres, ["depth", "tone"]), str(files / "one"))
    run.run(("ingest", "filter", "classify"))
    unknown = run.read("classify").where("classification.top = 'unknown'").count()
    run.force = True
    run.stage("classify")
    assert Flaky.asked == [40, unknown] and unknown > 0 and run.read("classify").where("classification.top = 'unknown'").count() == 0
    again = Run(spark, s, StubBackend(s.genres, ["depth", "tone"]), str(files / "two"))
    again.run(("ingest", "filter"))
    assert again.read("filter").count() == 0


def test_completions_and_missing_contents(monkeypatch):
    from inkmill.plans.backend import content_of

    assert content_of({"choices": [{"message": {"content": None}}]}, True) is None and content_of({"choices": [{"message": {"content": " a "}}]}, True) == "a"
    assert content_of({"choices": [{"text": " b "}]}, False) == "b" and content_of({"choices": []}, False) is None and content_of([], True) is None
    assert ModelSettings(endpoint="completions").endpoint == "completions"
    with pytest.raises(ValueError):
        ModelSettings(endpoint="other")


def test_counting_by_a_public_tokenizer(spark, files):
    path = Path("/opt/tokenizers/byte_bpe_50k.tiktoken")
    if not path.exists():
        pytest.skip("no vocabulary files")
    count = tokens.counter(str(path))
    df = spark.createDataFrame([("The ferry crossed the river.",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(count(F.col("t"))).collect()] == [6, 0, 0]
    s = replace(load_settings(files / "run.yaml", files / "datasets.yaml", files / "rubrics"), tokenizer=str(path), max_chunk_tokens=6)
    run = Run(spark, s, StubBackend(s.genres, ["depth"]), str(files / "bpe"))
    run.run(("ingest", "filter", "segment"))
    got = run.read("segment")
    assert got.count() == 80 and got.agg(F.max(count(F.col("response")))).first()[0] <= 7


def test_skipped_stage_passes_its_input_on(spark, files):
    s = load_settings(files / "run.yaml", files / "datasets.yaml", files / "rubrics")
    run = Run(spark, s, StubBackend(s.genres, ["depth", "tone"]), str(files / "skip"))
    run.run(skip=("segment", "normalize", "reconstruct"))
    assert run.read("score").count() == run.read("filter").count() == 40
    with pytest.raises(FileNotFoundError):
        Run(spark, s, StubBackend(s.genres, ["depth"]), str(files / "void")).stage("score")


class Service(http.server.BaseHTTPRequestHandler):
    fails = 0

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        if Service.fails:
            Service.fails -= 1
            self.send_error(500)
            return
        text = f" {body['messages'][-1]['content']}|{len(body['messages'])}|{self.headers.get('Authorization')} "
        reply = json.dumps({"choices": [{"message": {"content": text}}]}).encode()
        self.send_response(200)
        self.end_headers()
        self.wfile.write(reply)

    def log_message(self, *_):
        pass


def test_http_backend(spark, monkeypatch):
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    monkeypatch.setenv("SOME_KEY", "k")
    m = ModelSettings(f"http://127.0.0.1:{server.server_port}/v1", "ENV:SOME_KEY", "qwen3-x", 5, 2, 4)
    Service.fails, waits = 2, []
    assert call(m, "hi", temperature=0, max_tokens=5, sleep=waits.append) == "hi|2|Bearer k" and waits == [1, 2]
    df = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, request string")
    got = HttpBackend().answer(df, "scoring", ModelSettings(m.api_base_url, None, "other", 5, 0, 4), temperature=0, max_tokens=5)
    assert {r["id"]: r["content"] for r in got.collect()} == {"1": "a|1|None", "2": "b|1|None"}
    server.shutdown()
    server.server_close()
    assert call(m, "x", temperature=0, max_tokens=1, sleep=waits.append) is None


def test_streaming_matches_batch(spark, tmp_path):
    src = tmp_path / "in"
    rows = [(f"r{i}", f"text {i % 12} of the stream") for i in range(30)]
    df = spark.createDataFrame(rows, "id string, response string").withColumn("ingested_at", F.expr("timestamp'2025-01-01'"))
    df.repartition(3).write.parquet(str(src))
    stream = incremental.read_stream(spark, str(src), "id string, response string, ingested_at timestamp", 1)
    kept = incremental.filtered(stream, FilterSettings(2, 50, 0, ("text 3 ",)))
    for _ in range(2):
        q = incremental.append_new(kept, str(tmp_path / "out"), str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(60)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 11 == got.select("response").distinct().count()


def test_entry_has_sql_for_known_queries():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 40
    assert scoring.namespaced()
