from pyspark.sql import functions as F

from inkmill.functions import language
from inkmill.plans import cli

TEXTS = {"en": "The old clerk wrote a long letter about the rain that had fallen on the roofs of the town all night.", "de": "Der alte Schreiber verfasste einen langen Brief über den Regen, der die ganze Nacht auf die Dächer fiel.", "ru": "Ночью река тихо текла мимо деревни, и старый лодочник зажёг фонарь над водой у самого берега."}
RUBRIC = "name: default\nmetrics:\n  - {name: depth, description: d, prompt_hint: h}\n"


def test_language_filter_on_the_command_line(spark, tmp_path):
    (tmp_path / "rubrics").mkdir()
    (tmp_path / "rubrics" / "default.yaml").write_text(RUBRIC)
    (tmp_path / "run.yaml").write_text("preprocessing: {filter: {min_response_tokens: 2, lang_id_threshold: 0.9}}\nrubric_mapping: {'*': default}\n")
    (tmp_path / "texts.txt").write_text("\n".join(TEXTS.values()) + "\n")
    (tmp_path / "datasets.yaml").write_text(f"datasets:\n  - {{name: lines, path: {tmp_path}/texts.txt, format: text, type: B}}\n")
    args = lambda out: ["--run", f"{tmp_path}/run.yaml", "--datasets", f"{tmp_path}/datasets.yaml", "--rubrics", f"{tmp_path}/rubrics", "--folder", f"{tmp_path}/{out}", "--stub"]
    assert cli.main([*args("a"), "--", "ingest", "filter"]) == 0
    kept = spark.read.parquet(f"{tmp_path}/a/filter").collect()
    assert [r["response"] for r in kept] == [TEXTS["en"]] and kept[0]["meta"]["lang"] == "en"
    assert cli.main([*args("b"), "--detector", "tests.test_cli_detector:german", "--", "ingest", "filter"]) == 0
    assert spark.read.parquet(f"{tmp_path}/b/filter").count() == 0


def german(df):
    return F.lit("de"), F.lit(1.0)


def test_detected_languages(spark):
    texts = [*TEXTS.values(), "", None, "1234", "Le chat est dans la maison avec une souris.", "El perro está en la casa con los gatos y una vaca.", "Il cane è nella casa con il gatto, ma non con gli uccelli."]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, response string")
    lang, probability = language.detect(df)
    got = [(r["l"], r["p"]) for r in df.select("i", lang.alias("l"), probability.alias("p")).orderBy("i").collect()]
    assert [g[0] for g in got] == ["en", "de", None, None, None, None, "fr", "es", "it"]
    assert all(p > 0.7 if g else p == 0 for g, p in got)
