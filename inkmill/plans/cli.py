"""Command line: ``python -m inkmill.plans.cli --run run.yaml --datasets datasets.yaml --rubrics DIR --folder OUT [stages]``."""

from __future__ import annotations

import argparse
import importlib
import logging
import shutil
import sys
import time
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

from inkmill.functions import language
from inkmill.operators.scoring import RUBRICS
from inkmill.plans.backend import HttpBackend, StubBackend
from inkmill.plans.config import load_settings
from inkmill.plans.pipeline import LOG, STAGES, Run


def load_detector(name: str) -> object:
    """The function that ``module:function`` names: from records to the columns (language, probability)."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def run_folder(spark: SparkSession, a: argparse.Namespace) -> tuple[str, Path]:
    """The folder of the run and the place of its configuration.

    A new run gets ``--folder``, or a folder below ``--runs`` named by the time; its run file, dataset list and rubrics are
    copied to ``config`` there. ``--resume`` goes on with a run by its own copies. What happens is logged to
    ``logs/pipeline.log`` where the folder is on this machine.
    """
    folder = a.resume or a.folder or f"{a.runs.rstrip('/')}/run_{time.strftime('%Y%m%d_%H%M%S')}_{uuid.uuid4().hex[:6]}"
    config = Path(folder) / "config"
    if not a.resume:
        (config / "rubrics").mkdir(parents=True, exist_ok=True)
        shutil.copy(a.run, config / "run.yaml")
        shutil.copy(a.datasets, config / "datasets.yaml")
        for f in Path(a.rubrics).glob("*.yaml"):
            shutil.copy(f, config / "rubrics" / f.name)
    (Path(folder) / "logs").mkdir(parents=True, exist_ok=True)
    handler = logging.FileHandler(Path(folder) / "logs" / "pipeline.log")
    handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
    for old in [h for h in LOG.handlers if isinstance(h, logging.FileHandler)]:
        LOG.removeHandler(old)
    LOG.addHandler(handler)
    LOG.setLevel(logging.INFO)
    return folder, config


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="inkmill")
    for name in ("run", "datasets", "rubrics", "folder"):
        p.add_argument(f"--{name}")
    p.add_argument("--runs", default="runs", help="where a run without --folder gets its own")
    p.add_argument("--resume", help="folder of a run to go on with, by its copies of the configuration")
    p.add_argument("--stub", action="store_true", help="answer by rule instead of asking a model")
    p.add_argument("--force", action="store_true", help="run stages again that have output")
    p.add_argument("--clear", nargs="*", default=[], metavar="STAGE[:DATASET]", help="forget the output of stages, or of one dataset of the ingest stage")
    p.add_argument("--detector", help="module:function that gives language and probability, in place of the built-in detector")
    p.add_argument("--skip", nargs="*", default=[], choices=STAGES)
    p.add_argument("stages", nargs="*", default=list(STAGES))
    a = p.parse_args(args)
    if not a.resume and not (a.run and a.datasets and a.rubrics):
        p.error("--run, --datasets and --rubrics are needed, or --resume")
    spark = SparkSession.builder.appName("inkmill").getOrCreate()
    folder, config = run_folder(spark, a)
    settings = load_settings(config / "run.yaml", config / "datasets.yaml", config / "rubrics")
    every = sorted({m for ms in (settings.metrics() or RUBRICS).values() for m in ms})
    backend = StubBackend(settings.genres, every) if a.stub else HttpBackend()
    run = Run(spark, settings, backend, folder, force=a.force, detector=load_detector(a.detector) if a.detector else language.detect)
    for name in a.clear:
        stage, _, dataset = name.partition(":")
        run.clear(stage, dataset or None)
    run.run(tuple(a.stages), tuple(a.skip))
    return 0


if __name__ == "__main__":
    sys.exit(main())
