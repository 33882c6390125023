import pytest
from pyspark.sql import functions as F

from inkmill.schema import RECORD
from inkmill.sources import ingest, readers
from inkmill.sources.index import with_row_index

TURNS = "id string, conversations array<struct<from:string,value:string>>, n int"
CONVERSATIONS = [
    ("simple", [("human", "q"), ("gpt", "a")], "q", "a"),
    ("last", [("human", "q"), ("gpt", "a"), ("human", "q2"), ("gpt", "a2")], "q2", "a2"),
    ("trailing", [("user", "q"), ("assistant", "a"), ("user", "z")], "q", "a"),
    ("system", [("system", "s"), ("human", "q"), ("gpt", "a")], "q", "a"),
    ("mixed", [("Human", "q"), ("ChatGPT", "a")], "q", "a"),
    (None, [("human", "q"), ("gpt", "a")], "q", "a"),
    ("gap", [("human", "q"), ("system", "s"), ("gpt", "a")], None, None),
    ("short", [("human", "q")], None, None),
    ("empty_last", [("human", "q"), ("gpt", "x"), ("human", "q"), ("gpt", "")], None, None),
    ("nulls", [None, ("human", None), ("gpt", "a")], None, None),
    ("none", None, None, None),
    ("no_turns", [], None, None),
]


def test_conversations(spark):
    df = spark.createDataFrame([(i, c, n) for n, (i, c, _, _) in enumerate(CONVERSATIONS)], TURNS)
    df = df.union(df.where("id = 'simple'").withColumn("n", F.lit(99)))
    got = {r["meta"]["original_id"]: (r["prompt"], r["response"]) for r in ingest.ingest_conversations(df, "c", order=["n"]).collect()}
    assert got == {i or "item_5": (p, a) for i, _, p, a in CONVERSATIONS if a}
    assert ingest.ingest_conversations(df, "c", order=["n"]).schema == RECORD or [f.name for f in RECORD] == ingest.ingest_conversations(df, "c", order=["n"]).columns


def test_texts_and_extra_columns(spark):
    df = spark.createDataFrame([(1, " a \n\n b ", "x"), (2, "   ", "y"), (3, None, "z"), (4, "c", None)], "n int, text string, id string")
    got = {r["meta"]["original_id"]: r["response"] for r in ingest.ingest_texts(df, "b", id_column="id", order=["n"]).collect()}
    assert got == {"x": "a\nb", "item_3": "c"}
    assert ingest.ingest_texts(df.limit(0), "b", order=["n"]).count() == 0


def test_row_index(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(7)
    got = with_row_index(df, ["k"]).collect()
    assert all(r["k"] == r["row_index"] for r in got) and len(got) == 1000


@pytest.mark.parametrize(("limit", "n"), [(3, 3), ("25%", 2), ("5%", 0), (None, 10), (100, 10), ("100%", 10)])
def test_limits(spark, limit, n):
    df = spark.range(10).toDF("k")
    assert sorted(r["k"] for r in readers.limited(df, limit, ["k"]).collect()) == list(range(n))


def test_formats(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"text": "one"}\nbroken\n{"text": "two"}\n')
    assert sorted(r["text"] for r in readers.read_source(spark, str(tmp_path / "a.jsonl"), "jsonl", schema="text string").where("text is not null").collect()) == ["one", "two"]
    with pytest.raises(Exception):
        readers.read_source(spark, str(tmp_path / "a.jsonl"), "jsonl", schema="text string", strict=True).collect()
    (tmp_path / "a.csv").write_text('text,n\n"a ""q""\nb",1\n')
    assert readers.read_source(spark, str(tmp_path / "a.csv"), "csv").first()["text"] == 'a "q"\nb'
    (tmp_path / "a.txt").write_text("l1\nl2\n")
    assert readers.read_source(spark, str(tmp_path / "a.txt"), "text").count() == 2
    folder = tmp_path / "dir"
    (folder / "sub").mkdir(parents=True)
    for name, body in (("b.txt", "B\n\nb"), ("a.txt", "A"), ("c.md", "no")):
        (folder / name).write_text(body)
    (folder / "sub" / "d.txt").write_text("below")
    files = readers.read_source(spark, str(folder), "text_dir", max_items=1)
    assert [r["file_name"] for r in files.collect()] == ["a.txt"]
    whole = ingest.ingest_files(readers.read_source(spark, str(folder), "text_dir"), "files")
    assert {r["meta"]["original_id"]: r["response"] for r in whole.collect()} == {"a.txt": "A", "b.txt": "B\nb"}
    with pytest.raises(ValueError):
        readers.read_source(spark, str(folder), "xml")


@pytest.mark.parametrize("fmt", ["parquet", "jsonl"])
def test_round_trip(spark, tmp_path, fmt):
    df = ingest.ingest_texts(spark.createDataFrame([("a",), ("b",)], "text string"), "b", order=["text"])
    path = str(tmp_path / fmt)
    readers.write_records(df, path, fmt)
    assert readers.exists(spark, path) and not readers.exists(spark, path + "x")
    assert sorted(map(str, readers.read_records(spark, path, fmt).collect())) == sorted(map(str, df.collect()))
